"""Silver: typed, conformed, deduplicated entities (P-01 … P-07, W-01, M-01, M-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import typed
from ..operators.dedup import first_per_key
from ..sources.schemas import TYPED


def typed_projection(bronze: DataFrame, source: str, keep: list[str] | None = None) -> DataFrame:
    """F-01: every declared column through ``try_cast`` (a no-op when already typed); ``keep``
    passes further columns through unchanged."""
    return bronze.select(*[typed(n, t.simpleString()).alias(n) for n, t in TYPED[source]], *(keep or []))


def study(bronze: DataFrame) -> DataFrame:
    """P-01: typed study + ``planned_end_date = start_date + planned_duration_days``."""
    s = typed_projection(bronze, "studies")
    return s.withColumn("planned_end_date", F.date_add("start_date", F.col("planned_duration_days")))


def site(bronze: DataFrame) -> DataFrame:
    """P-02: typed site + ``is_decentralized``."""
    s = typed_projection(bronze, "sites")
    return s.withColumn("is_decentralized", F.col("site_type").isin(C.DECENTRALIZED_SITE_TYPES))


def patient(bronze: DataFrame) -> DataFrame:
    """P-03."""
    cols = TYPED["patients"]
    extra = [c for c in ("_ingest_ts",) if c in bronze.columns]
    return bronze.select(*[typed(n, t.simpleString()).alias(n) for n, t in cols], *extra)


def funnel(bronze: DataFrame, key=C.DEFAULT.funnel_key) -> DataFrame:
    """W-01: first occurrence per key, ties broken by (event_date, study_id, site_id)."""
    t = typed_projection(bronze, "funnel_events")
    order = ["event_date"] + [c for c in ("study_id", "site_id") if c not in key]
    return first_per_key(t, list(key), order)


def marketing(bronze: DataFrame) -> DataFrame:
    """P-04."""
    return typed_projection(bronze, "marketing_daily")


def campaign(bronze: DataFrame) -> DataFrame:
    """P-05."""
    return typed_projection(bronze, "campaigns")


def site_costs(bronze: DataFrame) -> DataFrame:
    """P-06."""
    return typed_projection(bronze, "site_costs")


def budget(bronze: DataFrame) -> DataFrame:
    """P-07."""
    return typed_projection(bronze, "study_budgets")


def rejects(bronze: DataFrame, source: str) -> DataFrame:
    """Rows where some non-NULL text failed its cast (the reject count Silver reports)."""
    bad = F.lit(False)
    for n, t in TYPED[source]:
        bad = bad | (F.col(n).isNotNull() & typed(n, t.simpleString()).isNull())
    return bronze.filter(bad)
