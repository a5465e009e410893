"""End-to-end medallion run over a landing folder: Bronze streams -> incremental Silver -> Gold.

    lake/
      bronze/<source>/_ingest_date=…/       append-only, stamped (streaming sink)
      _checkpoints/<source>/                 stream progress (exactly-once file discovery)
      silver/dim_patient, silver/funnel_events
                                             state by key bucket (``bucket=…/load=…``)
      silver/_load_watermark/load=…          marks; a load counts once it has them
      gold/fact_patient_enrollment, gold/cells, gold/kpi_… by study
                                             by key bucket, kept up by changes
      gold/<table>/                          dimensions and small marts, overwritten

Silver order of writes: the batch's upper marks, then the state tables, then the marks. A crash
in between makes the retry read the same Bronze rows again, up to the upper marks, and both SCD2 and the
first-wins upsert are replay-safe, so nothing is lost or doubled, also if new rows landed meanwhile. Reference dimensions that are re-delivered keep the latest row per key.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators.dedup import last_per_key
from ..operators.scd2 import current_view
from ..session import table_exists
from ..sources.landing import write_parquet
from ..sources.quarantine import COLUMNS as QUARANTINE
from ..sources.quarantine import rejects, wellformed
from ..streaming.incremental import bronze_schema
from ..streaming.ingest import ingest_all
from . import gold as G
from . import silver as SV
from .cells import Rollup
from .gold_state import GoldStore
from .observed import PublicationError  # noqa: F401 - what publish_gold raises
from .pipeline import DIM_PATIENT_COLS
from .silver_state import FED_BY, Load, SilverStore

# latest row per business key for re-deliverable reference data
REFERENCE_KEYS = {
    "studies": ["study_id"],
    "sites": ["site_id"],
    "campaigns": ["campaign_id"],
    "study_budgets": ["study_id"],
    "marketing_daily": ["campaign_id", "activity_date"],
    "site_costs": ["study_id", "site_id", "month"],
}


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def bronze_path(self, source: str) -> str:
        return f"{self.root}/bronze/{source}"

    def bronze(self, source: str) -> DataFrame:
        """The well-formed rows of a source."""
        p = self.bronze_path(source)
        if not table_exists(self.spark, p):
            return self.spark.createDataFrame([], bronze_schema(source))
        return wellformed(self.spark.read.schema(bronze_schema(source)).parquet(p))

    def rejects(self, source: str) -> DataFrame:
        """What of ``source`` is in quarantine: malformed records and failed casts, with file and reason."""
        if not table_exists(self.spark, self.bronze_path(source)):
            return self.spark.createDataFrame([], ", ".join(f"{c} string" for c in QUARANTINE))
        return rejects(self.spark.read.schema(bronze_schema(source)).parquet(self.bronze_path(source)), source)

    def silver(self, params: C.Params = C.DEFAULT) -> SilverStore:
        return SilverStore(self.spark, f"{self.root}/silver", params)


def ingest_bronze(spark: SparkSession, landing: str, lake: Lake, sources=C.SOURCES) -> None:
    """All sources in parallel, each a checkpointed run-to-completion stream."""
    specs = [(s, f"{landing.rstrip('/')}/{s}/*/", lake.bronze_path(s), f"{lake.root}/_checkpoints/{s}") for s in sources]
    ingest_all(spark, specs)


def silver_run(spark: SparkSession, lake: Lake, batch_id: str, params: C.Params = C.DEFAULT) -> Load:
    """One incremental Silver run: the load's number and the key buckets it wrote."""
    return lake.silver(params).run({s: lake.bronze(s) for s in FED_BY.values()}, batch_id)


def reject_rows(lake: Lake, source: str) -> DataFrame:
    """Bronze rows of ``source`` in which some text fails its cast in Silver (it becomes NULL there)."""
    return SV.rejects(lake.bronze(source), source)


def _reference(lake: Lake, source: str) -> DataFrame:
    b = lake.bronze(source)
    key = REFERENCE_KEYS[source]
    typed = SV.typed_projection(b, source, keep=["_ingest_ts"])
    return last_per_key(typed, key, ["_ingest_ts"]).drop("_ingest_ts")


def gold_star(spark: SparkSession, lake: Lake, params: C.Params = C.DEFAULT) -> G.Lazy:
    silver = G.Lazy({
        "study": lambda: SV.study(_reference(lake, "studies")),
        "site": lambda: SV.site(_reference(lake, "sites")),
        "funnel": lambda: lake.silver(params).table("funnel_events"),
        "marketing": lambda: _reference(lake, "marketing_daily"),
        "campaign": lambda: _reference(lake, "campaigns"),
        "site_costs": lambda: _reference(lake, "site_costs"),
        "budget": lambda: _reference(lake, "study_budgets"),
    })
    dim = lambda: current_view(lake.silver(params).table("dim_patient"), DIM_PATIENT_COLS)
    return G.build_star(spark, silver, dim, params)


DIMENSIONS = ["dim_study", "dim_site", "dim_patient", "dim_campaign", "dim_date", "fact_marketing_daily", "fact_site_financials", "study_budgets"]


def gold_store(spark: SparkSession, lake: Lake, dims: dict, params: C.Params = C.DEFAULT) -> GoldStore:
    return GoldStore(spark, f"{lake.root}/gold", lake.silver(params), dims, params)


def publish_gold(spark: SparkSession, lake: Lake, params: C.Params = C.DEFAULT) -> dict:
    """Bring the fact, the cells and the marts up to Silver's last load, then write the dimensions whole
    (they come from reference data). What was written: see ``GoldStore.publish``."""
    star = gold_star(spark, lake, params)
    dims = G.Lazy({n: (lambda n=n: star[n]) for n in DIMENSIONS})
    out = gold_store(spark, lake, dims, params).publish()
    frames = {n: star[n] for n in DIMENSIONS}  # plans are built on this thread; the writes run concurrently
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda n: write_parquet(frames[n], f"{lake.root}/gold/{n}"), DIMENSIONS))
    return out


def run(spark: SparkSession, landing: str, lake_root: str, batch_id: str, params: C.Params = C.DEFAULT) -> G.Lazy:
    """``make run``: Bronze ingest, one Silver run, Gold publish; the published tables."""
    lake = Lake(spark, lake_root)
    ingest_bronze(spark, landing, lake)
    silver_run(spark, lake, batch_id, params)
    publish_gold(spark, lake, params)
    return published(spark, lake_root, params)


WHOLE = ["kpi_accessibility_reach", "kpi_predictability_forecast", "kpi_overview"]


def published(spark: SparkSession, lake_root: str, params: C.Params = C.DEFAULT) -> G.Lazy:
    """Serving read: the published Gold tables of a lake (dashboards and measures read these). KPIs are
    answered from its cells, measures from its roll-up where a level holds them."""
    lake = Lake(spark, lake_root)
    root = f"{lake.root}/gold"
    dims = G.Lazy({n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in DIMENSIONS})
    store = gold_store(spark, lake, dims, params)
    return G.Lazy({**{n: (lambda n=n: dims[n]) for n in DIMENSIONS}, **{n: (lambda n=n: spark.read.parquet(store.whole(n))) for n in WHOLE}, **store.tables(),
                   "rollup": lambda: Rollup(spark, store.whole("rollup")), "checks": lambda: spark.read.parquet(store.whole("_checks"))})
