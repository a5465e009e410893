"""The stored Silver state: SCD2 patients and the funnel by key bucket, and the marks of each load.

One run reads Bronze above the marks of the load before, merges it into the buckets it touches, and
writes its marks last. How far a run reads is fixed before it writes any state (``_batch_upper_marks``),
so a run that is repeated after a crash reads the same rows, also if others landed meanwhile.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import ts_lit
from ..operators import watermark as WM
from ..operators.bucketed import BucketedTable, LoadMarks
from ..operators.scd2 import scd2_apply
from ..operators.upsert import first_wins_upsert
from ..sources.schemas import DIM_PATIENT_SCHEMA, SILVER_FUNNEL_SCHEMA
from . import silver as SV

PATIENT_KEY = "patient_id"
FUNNEL_ORDER = ["event_date", "study_id", "site_id"]
#: State table -> Bronze source.
FED_BY = {"dim_patient": "patients", "funnel_events": "funnel_events"}


@dataclass(frozen=True)
class Load:
    """What a run did: its number and the buckets it wrote by table."""

    number: int
    touched: Mapping[str, list[int]]


class SilverStore:
    def __init__(self, spark: SparkSession, root: str, params: C.Params = C.DEFAULT):
        self.spark, self.root, self.params = spark, root.rstrip("/"), params
        self.tables = {
            "dim_patient": BucketedTable(spark, f"{self.root}/dim_patient", DIM_PATIENT_SCHEMA, [PATIENT_KEY], params.state_buckets),
            "funnel_events": BucketedTable(spark, f"{self.root}/funnel_events", SILVER_FUNNEL_SCHEMA, params.funnel_key[:1], params.state_buckets),
        }
        self.marks = LoadMarks(spark, f"{self.root}/_load_watermark")
        self.upper = LoadMarks(spark, f"{self.root}/_batch_upper_marks")

    def table(self, name: str, load: int | None = None) -> DataFrame:
        """A state table as of a load, the last complete one if none is given."""
        return self.tables[name].read(self.marks.last() if load is None else load)

    def run(self, bronze: Mapping[str, DataFrame], batch_id: str) -> Load:
        """One incremental run over Bronze; a batch that is already in the state changes nothing."""
        p = self.params
        if self.marks.last() and (done := self.marks.load_of(batch_id)) is not None:
            return Load(done, {n: [] for n in self.tables})
        number = self.marks.last() + 1
        marks = self.marks.read()
        at = WM.read_marks(marks, list(self.tables))
        new = {n: WM.after_mark(bronze[s], "_ingest_ts", at[n]) for n, s in FED_BY.items()}
        until = self._until(new, number, batch_id)
        new = {n: df.filter(F.col("_ingest_ts") <= ts_lit(until[n])) for n, df in new.items() if n in until}
        jobs = {}
        if "dim_patient" in new:
            ts = until["dim_patient"]
            jobs["dim_patient"] = (SV.patient(new["dim_patient"]).filter(F.col(PATIENT_KEY).isNotNull()), lambda stored, batch: scd2_apply(
                stored, batch, PATIENT_KEY, C.SCD2_ATTRIBUTES, list(p.tracked), ts))
        if "funnel_events" in new:
            jobs["funnel_events"] = (SV.typed_projection(new["funnel_events"], "funnel_events"), lambda stored, batch: first_wins_upsert(
                stored, batch, list(p.funnel_key), FUNNEL_ORDER))
        # the two tables are independent: merged concurrently, the marks only afterwards
        with ThreadPoolExecutor(max_workers=2) as pool:
            running = {n: pool.submit(self.tables[n].merge, batch, apply, number) for n, (batch, apply) in jobs.items()}
            touched = {n: f.result() for n, f in running.items()}
        for n, u in until.items():
            marks = WM.advance(marks, n, self.spark.range(1).select(ts_lit(u).alias("watermark")))
        self.marks.write(marks, number, batch_id)
        return Load(number, {n: touched.get(n, []) for n in self.tables})

    def _until(self, new: Mapping[str, DataFrame], number: int, batch_id: str) -> dict:
        """State table -> ingest time up to which the load reads; tables without new rows are left out."""
        if not self.upper.has(number):
            found = [df.agg(F.max("_ingest_ts").alias("watermark")).select(F.lit(n).alias("table_name"), "watermark") for n, df in new.items()]
            self.upper.write(found[0].unionByName(found[1]), number, batch_id)
        return {r["table_name"]: r["watermark"] for r in self.upper.read(number).collect() if r["watermark"] is not None}
