"""The medallion run over driver tables: landing shapes -> Bronze -> Silver -> Gold.

The driver-table scenario is an incremental run with two loads:

* load 1 is stamped ``LOAD1_TS`` (2024-01-15): every source, the first patient extract, and
  funnel events dated before 2024-01-15;
* load 2 is stamped ``LOAD2_TS`` (2024-02-01): a full patient re-extract in which some patients
  moved site, and the funnel events dated from 2024-01-15 on.

Silver runs after each load and only reads Bronze rows above its high-water mark.

With a ``store`` folder (the shared folder of the cluster), the expensive landed shapes are
written once as Parquet tables (Bronze partitioned by ``_ingest_date``), and every Silver run
merges its rows into the stored state (``SilverStore``) and reads it back: lineage is cut per
load, executor loss only recomputes the current step, a load writes the key buckets it touches, and
the mark filters prune Bronze partitions. Without a store everything stays a lazy plan (unit tests).
"""

from __future__ import annotations

import datetime as _dt
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import watermark as WM
from ..operators.scd2 import current_view, empty_like, scd2_apply
from ..operators.upsert import first_wins_upsert
from ..sources import fixtures as FX
from ..sources.bronze import stamp
from ..sources.driver_tables import load_tables
from ..sources.schemas import DIM_PATIENT_SCHEMA, SILVER_FUNNEL_SCHEMA
from . import gold as G
from . import silver as SV
from .silver_state import FUNNEL_ORDER, PATIENT_KEY, SilverStore

LOAD1_TS = _dt.datetime(2024, 1, 15)
LOAD2_TS = _dt.datetime(2024, 2, 1)
SPLIT_DATE = _dt.date(2024, 1, 15)
DIM_PATIENT_COLS = ["patient_sk", "patient_id", "study_id", "site_id", "age", "sex", "race_ethnicity", "is_rural"]

# landed shapes worth storing once (joins, windows, JSON parsing); the rest stay lazy views
STORED_SHAPES = ["funnel_events", "patients", "patients_changed", "marketing_daily", "site_costs"]
# those derived from the events' study slots, which are parsed and stored once for all of them
FROM_SLOTS = ["funnel_events", "patients", "patients_changed"]


def source_file(source: str, load: int) -> str:
    return f"landing/{source}/load_{load}.csv"


class Landed:
    """The driver tables mapped to landing source shapes, each expensive one written once.

    The stored shapes are landed together on first use, as concurrent Spark jobs (independent
    writes; on small inputs their single-task stages would otherwise leave most cores idle)."""

    def __init__(self, spark: SparkSession, sf_dir: str, store: str | None = None):
        self.spark = spark
        self.tables = load_tables(spark, sf_dir)
        self.store = store.rstrip("/") if store else None
        self._frames: dict = {}
        self._lock = threading.RLock()
        self._slots_lock = threading.Lock()
        self._prefetched = False

    def _store_slots(self) -> None:
        """The events' slots as a stored table; the first of the concurrent jobs that need it writes it."""
        with self._slots_lock:
            if "event_slots" not in self.tables:
                path = f"{self.store}/landed/event_slots"
                slots = FX.event_slots(self.tables)
                slots.write.mode("overwrite").parquet(path)
                self.tables["event_slots"] = self.spark.read.schema(slots.schema).parquet(path)

    def _build(self, name: str) -> DataFrame:
        if name == "patients_changed":
            return FX.patients_changed(self.tables)
        return FX.source(self.tables, name)

    def _land(self, name: str) -> DataFrame:
        if self.store and name in FROM_SLOTS:
            self._store_slots()
        df = self._build(name)
        if self.store and name in STORED_SHAPES:
            path = f"{self.store}/landed/{name}"
            df.write.mode("overwrite").parquet(path)
            df = self.spark.read.parquet(path)
        return df

    def prefetch(self, names=STORED_SHAPES) -> None:
        with self._lock:
            todo = [n for n in names if n not in self._frames]
            if not todo:
                return
            with ThreadPoolExecutor(max_workers=len(todo)) as pool:
                for n, df in zip(todo, pool.map(self._land, todo)):
                    self._frames[n] = df
            self._prefetched = True

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._frames:
                if self.store and name in STORED_SHAPES and not self._prefetched:
                    self.prefetch()
                if name not in self._frames:
                    self._frames[name] = self._land(name)
            return self._frames[name]


@dataclass
class SilverState:
    dim_patient: DataFrame
    funnel: DataFrame
    marks: DataFrame


@dataclass
class Run:
    spark: SparkSession
    landed: Landed
    params: C.Params
    bronze: dict = field(default_factory=dict)
    loads: int = 2
    _silver: dict | None = None
    _states: list = field(default_factory=list)
    _star: G.Lazy | None = None
    _lock: threading.RLock = field(default_factory=threading.RLock)
    _bronze_cache: dict = field(default_factory=dict)
    _stored: SilverStore | None = None

    @property
    def store(self) -> str | None:
        return self.landed.store

    @property
    def silver(self) -> dict:
        """Silver after all loads (built on first use: each run reads its mark first)."""
        with self._lock:
            if self._silver is None:
                self.build_silver(self.loads)
            return self._silver

    @property
    def states(self) -> list:
        self.silver  # noqa: B018
        return self._states

    # ---- Bronze ----
    def build_bronze(self) -> None:
        ld = self.landed
        # reference sources stay lazy: a query that never reads them never lands them
        b = G.Lazy({s: (lambda s=s: stamp(ld[s], LOAD1_TS, source_file(s, 1)))
                    for s in C.SOURCES if s not in ("patients", "funnel_events")}
                   | {"patients": lambda: self._bronze_cache["patients"],
                      "funnel_events": lambda: self._bronze_cache["funnel_events"]})
        p1 = stamp(ld["patients"], LOAD1_TS, source_file("patients", 1))
        p2 = stamp(ld["patients_changed"], LOAD2_TS, source_file("patients", 2))
        fe = ld["funnel_events"]
        e1 = stamp(fe.filter(F.col("event_date") < F.lit(SPLIT_DATE)), LOAD1_TS, source_file("funnel_events", 1))
        e2 = stamp(fe.filter(F.col("event_date") >= F.lit(SPLIT_DATE)), LOAD2_TS, source_file("funnel_events", 2))
        with ThreadPoolExecutor(max_workers=2) as pool:  # two independent writes
            fp = pool.submit(self._stored_bronze, "patients", p1.unionByName(p2))
            ff = pool.submit(self._stored_bronze, "funnel_events", e1.unionByName(e2))
            self._bronze_cache = {"patients": fp.result(), "funnel_events": ff.result()}
        self.bronze = b

    def _stored_bronze(self, source: str, df: DataFrame) -> DataFrame:
        if not self.store:
            return df
        path = f"{self.store}/bronze/{source}"
        # sorted by patient, with a Bloom filter: a trace skips the row groups that can't hold its patient
        (df.withColumn("_ingest_date", F.to_date("_ingest_ts")).sortWithinPartitions("_ingest_date", "patient_id").write.mode("overwrite")
         .option("parquet.bloom.filter.enabled#patient_id", "true").option("parquet.bloom.filter.adaptive.enabled", "true").partitionBy("_ingest_date").parquet(path))
        return self.spark.read.parquet(path)

    # ---- Silver ----
    def empty_state(self) -> SilverState:
        return SilverState(empty_like(self.spark, DIM_PATIENT_SCHEMA), empty_like(self.spark, SILVER_FUNNEL_SCHEMA),
                           WM.empty_marks(self.spark))

    @property
    def stored(self) -> SilverStore:
        """The stored Silver state (a run with a store)."""
        if self._stored is None:
            self._stored = SilverStore(self.spark, f"{self.store}/silver", self.params)
        return self._stored

    def silver_increment(self, state: SilverState, bronze: dict, batch_id: str) -> SilverState:
        """One Silver run: read Bronze above each mark, apply SCD2 and the first-wins upsert,
        advance both marks to the max ingest time of the rows actually read."""
        p = self.params
        if self.store:
            n = self.stored.run(bronze, batch_id).number
            return SilverState(self.stored.table("dim_patient", n), self.stored.table("funnel_events", n), self.stored.marks.read(n))
        m = WM.read_marks(state.marks, ["dim_patient", "funnel_events"])
        bp = WM.after_mark(bronze["patients"], "_ingest_ts", m["dim_patient"])
        bf = WM.after_mark(bronze["funnel_events"], "_ingest_ts", m["funnel_events"])
        new_p = bp.agg(F.max("_ingest_ts").alias("watermark"))
        new_f = bf.agg(F.max("_ingest_ts").alias("watermark"))
        batch_ts = new_p.first()["watermark"]
        if batch_ts is None:
            dim = state.dim_patient
        else:
            dim = scd2_apply(state.dim_patient, SV.patient(bp), PATIENT_KEY, C.SCD2_ATTRIBUTES, list(p.tracked),
                             batch_ts)
        funnel = first_wins_upsert(state.funnel, SV.funnel(bf, p.funnel_key), list(p.funnel_key), FUNNEL_ORDER)
        marks = WM.advance(WM.advance(state.marks, "dim_patient", new_p), "funnel_events", new_f)
        return SilverState(dim, funnel, marks)

    def build_silver(self, loads: int = 2) -> None:
        state = self.empty_state()
        self._states = [state]
        for i in range(loads):
            cutoff = [LOAD1_TS, LOAD2_TS][i]
            # Bronze as it stood after load i
            seen = {k: WM.until(self.bronze[k], "_ingest_ts", cutoff) for k in ("patients", "funnel_events")}
            state = self.silver_increment(state, seen, f"load_{i + 1}")
            self._states.append(state)
        b = self.bronze
        self._silver = G.Lazy({
            "study": lambda: SV.study(b["studies"]),
            "site": lambda: SV.site(b["sites"]),
            "patient": lambda: SV.patient(b["patients"]),
            "funnel": lambda: state.funnel,
            "dim_patient": lambda: state.dim_patient,
            "marks": lambda: state.marks,
            "marketing": lambda: SV.marketing(b["marketing_daily"]),
            "campaign": lambda: SV.campaign(b["campaigns"]),
            "site_costs": lambda: SV.site_costs(b["site_costs"]),
            "budget": lambda: SV.budget(b["study_budgets"]),
        })

    def version(self, table: str, batch_id: str) -> DataFrame:
        """A stored Silver table as the batch left it."""
        return self.stored.table(table, self.stored.marks.load_of(batch_id))

    # ---- Gold ----
    def star(self) -> G.Lazy:
        with self._lock:
            if self._star is None:
                self._star = star(self)
            return self._star


def run(spark: SparkSession, sf_dir: str, params: C.Params = C.DEFAULT, loads: int = 2,
        landed: Landed | None = None) -> Run:
    r = Run(spark, landed or Landed(spark, sf_dir), params, loads=loads)
    r.build_bronze()
    return r


def star(r: Run) -> G.Lazy:
    """Gold star over Silver as all loads left it: ``dim_patient`` is the current projection of the
    SCD2 table, the fact pivots the deduplicated funnel. Nothing is computed before a table is
    asked for. With a store, the enrolment fact is written once as a Parquet table there (facts are
    tables, KPIs are views) and every mart reads the written table."""
    names = ["study", "site", "funnel", "dim_patient", "marketing", "campaign", "site_costs", "budget"]
    silver = G.Lazy({n: (lambda n=n: r.silver[n]) for n in names})
    s = G.build_star(r.spark, silver, lambda: current_view(silver["dim_patient"], DIM_PATIENT_COLS), r.params)
    if not r.store:
        return s
    builders = dict(s._builders)
    lazy_fact = builders["fact_patient_enrollment"]

    def fact():
        path = f"{r.store}/gold/fact_patient_enrollment"
        lazy_fact().write.mode("overwrite").parquet(path)
        return r.spark.read.parquet(path)

    builders["fact_patient_enrollment"] = fact
    return G.Lazy(builders)
