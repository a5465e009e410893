"""Declared schemas of the eleven landing sources, Bronze metadata and state tables.

Landing CSV is read with an all-string schema (Bronze keeps the text as delivered); Silver
casts to the typed schema with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B, DT, TS = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(),
                         T.DateType(), T.TimestampType())

TYPED: dict[str, list[tuple[str, T.DataType]]] = {
    "studies": [("study_id", S), ("protocol_number", S), ("sponsor", S), ("therapeutic_area", S), ("phase", S),
                ("target_enrollment", I), ("planned_duration_days", I), ("start_date", DT)],
    "sites": [("site_id", S), ("site_name", S), ("site_type", S), ("region", S), ("state", S),
              ("activated_date", DT), ("pi_name", S)],
    "patients": [("patient_id", S), ("study_id", S), ("site_id", S), ("age", I), ("sex", S),
                 ("race_ethnicity", S), ("is_rural", B)],
    "funnel_events": [("patient_id", S), ("study_id", S), ("site_id", S), ("stage", S), ("event_date", DT)],
    "visits": [("visit_id", S), ("patient_id", S), ("study_id", S), ("visit_number", I), ("visit_date", DT),
               ("status", S)],
    "adverse_events": [("ae_id", S), ("patient_id", S), ("study_id", S), ("severity", S), ("serious_flag", B),
                       ("onset_date", DT)],
    "campaigns": [("campaign_id", S), ("study_id", S), ("channel", S), ("geo", S), ("start_date", DT)],
    "marketing_daily": [("campaign_id", S), ("study_id", S), ("activity_date", DT), ("channel", S),
                        ("spend_usd", D), ("impressions", L), ("clicks", L), ("leads", L)],
    "study_budgets": [("study_id", S), ("currency", S), ("total_budget_usd", D)],
    "site_costs": [("study_id", S), ("site_id", S), ("month", DT), ("operating_cost_usd", D),
                   ("per_visit_cost_usd", D)],
    "invoices": [("invoice_id", S), ("study_id", S), ("sponsor", S), ("amount_usd", D), ("milestone", S),
                 ("status", S), ("invoice_date", DT)],
}

INGEST_TS = "_ingest_ts"
SOURCE_FILE = "_source_file"
#: Text of a malformed record; its columns are not used.
CORRUPT = "_corrupt_record"
BRONZE_META = [(INGEST_TS, TS), (SOURCE_FILE, S)]


def typed_schema(source: str) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in TYPED[source]])


def landing_schema(source: str) -> T.StructType:
    """CSV text schema: every column a string, in the declared order."""
    return T.StructType([T.StructField(n, S, True) for n, _ in TYPED[source]])


def columns(source: str) -> list[str]:
    return [n for n, _ in TYPED[source]]


def type_name(t: T.DataType) -> str:
    return t.simpleString()


WATERMARK_SCHEMA = T.StructType([T.StructField("table_name", S, False), T.StructField("watermark", TS, True)])

TIE_MARK_SCHEMA = T.StructType([*WATERMARK_SCHEMA.fields, T.StructField("row_key", S, False)])

DIM_PATIENT_SCHEMA = T.StructType([
    T.StructField("patient_sk", S), T.StructField("patient_id", S), T.StructField("study_id", S),
    T.StructField("site_id", S), T.StructField("age", I), T.StructField("sex", S),
    T.StructField("race_ethnicity", S), T.StructField("is_rural", B), T.StructField("effective_from", TS),
    T.StructField("effective_to", TS), T.StructField("is_current", B),
])

SILVER_FUNNEL_SCHEMA = typed_schema("funnel_events")
