"""Lineage and trace queries L-01 … L-08 over the two-load run (``pipeline.Run``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import watermark as WM
from ..operators.aggregates import groups_with_more_than
from ..operators.dedup import first_per_key
from . import kpi as K
from .pipeline import Run


def layer_counts(run: Run) -> DataFrame:
    """L-01 / O-02: row counts of every layer as one labelled union."""
    star = run.star()
    rels = [
        ("bronze.patients", run.bronze["patients"]),
        ("bronze.funnel_events", run.bronze["funnel_events"]),
        ("silver.dim_patient", run.silver["dim_patient"]),
        ("silver.funnel_events", run.silver["funnel"]),
        ("gold.dim_patient", star["dim_patient"]),
        ("gold.fact_patient_enrollment", star["fact_patient_enrollment"]),
    ]
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("rel"), "n") for name, df in rels]
    return reduce(DataFrame.unionByName, parts)


def rows_per_load(run: Run, source: str = "patients") -> DataFrame:
    """L-02: Bronze rows per (ingest time, source file)."""
    return run.bronze[source].groupBy("_ingest_ts", "_source_file").agg(
        F.count(F.lit(1)).alias("rows_ingested_in_run"))


def backlog(run: Run, table: str = "funnel_events", after_run: int = 1) -> DataFrame:
    """L-03: Bronze rows above the mark Silver held after run ``after_run``."""
    marks = run.states[after_run].marks
    mark = WM.read_mark(marks, table)
    rows = WM.after_mark(run.bronze[table], "_ingest_ts", mark)
    return rows.agg(F.count(F.lit(1)).alias("backlog")).select(F.lit(table).alias("table_name"), "backlog")


def multi_version_keys(run: Run) -> DataFrame:
    """L-05 / A-09: keys with more than one version."""
    return groups_with_more_than(run.silver["dim_patient"], ["patient_id"], 1, "versions")


def traced_patient(run: Run) -> DataFrame:
    """The key to trace: the smallest patient id with more than one version (one row)."""
    return multi_version_keys(run).agg(F.min("patient_id").alias("patient_id"))


def _of_patient(run: Run, patient_id: str | None):
    """A function that keeps a patient's rows: a literal filter, which reaches every scan, or without
    an id a semi join with the traced key."""
    if patient_id is not None:
        return lambda df: df.filter(F.col("patient_id") == patient_id)
    key = traced_patient(run)
    return lambda df: df.join(key, "patient_id", "left_semi")


def _silver_of(run: Run, table: str, entry: str, patient_id: str | None) -> DataFrame:
    """A patient's rows of a Silver table: of the stored state one key bucket is read."""
    if patient_id is not None and run.store:
        run.silver  # noqa: B018 - the loads are written
        return run.stored.tables[table].lookup(patient_id, run.stored.marks.last())
    return _of_patient(run, patient_id)(run.silver[entry])


def version_history(run: Run, patient_id: str | None = None) -> DataFrame:
    """L-04: every version of the chosen key (the traced one if none is)."""
    d = _silver_of(run, "dim_patient", "dim_patient", patient_id)
    return d.select("patient_id", "patient_sk", "site_id", "age", "sex", "race_ethnicity", "is_rural",
                    "effective_from", "effective_to", "is_current").orderBy("effective_from")


TRACE_COLS = ["step", "layer", "patient_id", "study_id", "site_id", "stage", "event_date", "effective_from",
              "is_current", "_ingest_ts", "_source_file"]


def _long(df: DataFrame, step: int, layer: str) -> DataFrame:
    types = {"step": "int", "layer": "string", "patient_id": "string", "study_id": "string", "site_id": "string",
             "stage": "string", "event_date": "date", "effective_from": "timestamp", "is_current": "boolean",
             "_ingest_ts": "timestamp", "_source_file": "string"}
    cols = []
    for c in TRACE_COLS:
        if c == "step":
            cols.append(F.lit(step).alias(c))
        elif c == "layer":
            cols.append(F.lit(layer).alias(c))
        elif c in df.columns:
            cols.append(F.col(c).cast(types[c]).alias(c))
        else:
            cols.append(F.lit(None).cast(types[c]).alias(c))
    return df.select(*cols)


def trace_patient(run: Run, patient_id: str | None = None) -> DataFrame:
    """L-06: the chosen patient (the traced one if none is) through fact, Gold dim, SCD2 versions,
    Silver events, Bronze events (duplicates included) and the Bronze patient rows, as one labelled
    long table."""
    star = run.star()
    sel = _of_patient(run, patient_id)

    parts = [
        _long(sel(star["fact_patient_enrollment"]), 1, "gold.fact_patient_enrollment"),
        _long(sel(star["dim_patient"]), 2, "gold.dim_patient"),
        _long(_silver_of(run, "dim_patient", "dim_patient", patient_id), 3, "silver.dim_patient"),
        _long(_silver_of(run, "funnel_events", "funnel", patient_id), 4, "silver.funnel_events"),
        _long(sel(run.bronze["funnel_events"]), 5, "bronze.funnel_events"),
        _long(sel(run.bronze["patients"]), 6, "bronze.patients"),
    ]
    return reduce(DataFrame.unionByName, parts)


def funnel_arithmetic(star: dict) -> DataFrame:
    """L-07: the conversion arithmetic behind the screen-fail rate, plus lead-to-enrolled."""
    return K.conversion(star).select("study_id", "leads", "screened", "randomized", "enrolled",
                                     "screen_fail_rate_pct", "lead_to_enrolled_pct").orderBy("study_id")


def forecast_slack(star: dict, params: C.Params = C.DEFAULT) -> DataFrame:
    """L-08: days between planned end and projected completion."""
    fc = K.forecast(star, params)
    return fc.select("study_id", "target_enrollment", "enrolled_to_date", "weekly_velocity", "planned_end_date",
                     "projected_completion_date", "on_track",
                     F.datediff("planned_end_date", "projected_completion_date").cast("bigint").alias("days_of_slack")
                     ).orderBy("on_track", "days_of_slack")  # O-01: NULLs first on ascending


def duplicates_removed(run: Run) -> DataFrame:
    """Bronze funnel rows the Silver dedup dropped, per study (the trace's "duplicates removed")."""
    b = run.bronze["funnel_events"].select("patient_id", "study_id", "site_id", "stage", "event_date")
    kept = first_per_key(b, list(run.params.funnel_key), ["event_date", "study_id", "site_id"])
    n_all = b.groupBy("study_id").agg(F.count(F.lit(1)).alias("bronze_rows"))
    n_kept = kept.groupBy("study_id").agg(F.count(F.lit(1)).alias("silver_rows"))
    return n_all.join(n_kept, "study_id").withColumn("duplicates", F.col("bronze_rows") - F.col("silver_rows"))
