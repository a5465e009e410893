"""Gold kept up by changes (D-06, K-01 … K-09).

The enrolment fact lies in the key buckets of Silver, so the buckets a load touched there are all that
can change here. Publishing a load

1. rebuilds the fact of those buckets from the same buckets of Silver;
2. takes their old fact rows out of the cells and puts the new ones in, as signed sums; what doesn't
   change cancels out, and what remains names the studies touched;
3. adds these changes to the cells of those studies, and writes their rows of the marts by study;
4. derives the marts that have a row a study or site type (reach, forecast, overview) and the roll-up of
   the cells, none of which reads the fact;
5. writes its marks, from which on the load counts. The data-quality checks are metrics of these writes
   (``observed``); a violated one ends the publication here, and readers keep the load before.

Loads that were never published are caught up in one go. A publication that stopped is run again under
the same number and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators.bucketed import BucketedTable, LoadMarks
from . import cells as CE
from . import gold as G
from . import kpi as K
from .observed import Checks
from .silver_state import PATIENT_KEY, SilverStore

#: Marts with rows by study, each a function of the star.
BY_STUDY: dict[str, Callable[[dict], DataFrame]] = {
    "kpi_speed_study": K.speed_study,
    "kpi_speed_site_weekly": K.speed_site_weekly,
    "kpi_accessibility_diversity": K.diversity,
    "kpi_predictability_conversion": K.conversion,
}


class GoldStore:
    """``dims`` are the star's lazily built tables besides the fact."""

    def __init__(self, spark: SparkSession, root: str, silver: SilverStore, dims: dict, params: C.Params = C.DEFAULT):
        self.spark, self.root, self.silver, self.dims, self.params = spark, root.rstrip("/"), silver, dims, params
        self.marks = LoadMarks(spark, f"{self.root}/_loads")
        fact = G.fact_patient_enrollment(silver.tables["funnel_events"].read(0), silver.tables["dim_patient"].read(0))
        self.fact = BucketedTable(spark, f"{self.root}/fact_patient_enrollment", fact.schema, [PATIENT_KEY], params.state_buckets)
        self.cells = BucketedTable(spark, f"{self.root}/cells", CE.CELL_SCHEMA, ["study_id"], params.study_buckets)
        empty = self._star(self.fact.read(0), self.cells.read(0))
        self.marts = {n: BucketedTable(spark, f"{self.root}/{n}", f(empty).schema, ["study_id"], params.study_buckets) for n, f in BY_STUDY.items()}

    def _star(self, fact: DataFrame, cells: DataFrame) -> G.Lazy:
        return G.Lazy({**{n: (lambda n=n: self.dims[n]) for n in self.dims.keys() if n != "fact_patient_enrollment"},
                       "fact_patient_enrollment": lambda: fact, "cells": lambda: cells})

    def fact_of(self, load: int, buckets: Sequence[int]) -> DataFrame:
        """The fact of some buckets, from Silver as of a load."""
        current = self.silver.tables["dim_patient"].read(load, buckets).filter(F.col("is_current"))
        return G.fact_patient_enrollment(self.silver.tables["funnel_events"].read(load, buckets), current)

    def publish(self) -> dict:
        """Bring Gold up to Silver's last load. Returns the load, and what was written: ``buckets`` of the
        fact and ``studies`` (their buckets) of the marts."""
        load, last = self.silver.marks.last(), self.marks.last()
        if load <= last:
            return {"load": last, "buckets": [], "studies": []}
        touched = sorted({b for t in self.silver.tables.values() for b, n in t.latest(load).items() if n > last})
        checks = Checks()
        self.fact.replace(touched, self.fact_of(load, touched), load, checks.fact(self.dims["dim_study"], self.dims["dim_site"]))
        checks.stop_at_violations()
        change = f"{self.root}/_cell_changes/load={load}"  # read three times; one row a changed cell
        CE.changes(self.fact.read(last, touched), self.fact.read(load, touched)).write.mode("overwrite").parquet(change)
        changes = self.spark.read.schema(CE.CELL_SCHEMA).parquet(change)
        self.cells.merge(changes, CE.added, load)
        studies = self._changed_studies(changes, last)
        buckets = self.cells.touched(studies)
        star = self._star(self.fact.read(load), self.cells.read(load, buckets))
        star["dim_study"] = self.dims["dim_study"].filter(self.cells.bucket().isin(buckets))
        watch = {"kpi_predictability_conversion": checks.conversion, "kpi_accessibility_diversity": checks.diversity}
        for name, f in BY_STUDY.items():
            self.marts[name].replace(buckets, f(star), load, watch.get(name))
        checks.stop_at_violations()
        self._whole(load, checks)
        for name in ("dim_study", "dim_site", "dim_patient"):
            checks.add(f"nonempty:{name}", int(self.dims[name].isEmpty()))
        checks.add("nonempty:fact_patient_enrollment", int(self.cells.read(load).isEmpty()))
        checks.stop_at_violations()
        checks.frame(self.spark).write.mode("overwrite").parquet(f"{self.root}/_checks/load={load}")
        marks = self.dims["dim_study"].select(F.lit("studies").alias("table_name"), F.lit(None).cast("timestamp").alias("watermark")).limit(0)
        self.marks.write(marks, load, f"gold-{load}")
        return {"load": load, "buckets": touched, "studies": buckets}

    def _changed_studies(self, changes: DataFrame, last: int) -> DataFrame:
        """Studies with changed cells, or whose dimension row isn't the one of the publication before."""
        path = f"{self.root}/dim_study"
        now = self.dims["dim_study"]
        if last:
            before = self.spark.read.schema(now.schema).parquet(path)
            now = now.exceptAll(before).unionByName(before.exceptAll(now))
        return changes.select("study_id").unionByName(now.select("study_id")).distinct()

    def _whole(self, load: int, checks: Checks) -> None:
        """Tables that are small or depend on the reference data and the date, written whole: from the cells,
        to a folder of this load, so that those of the load before stay until it counts."""
        star = self._star(self.fact.read(load), self.cells.read(load))
        p = self.params
        frames = {"kpi_accessibility_reach": K.reach(star), "kpi_predictability_forecast": K.forecast(star, p), "kpi_overview": K.overview(star, p)}
        watch = {"kpi_predictability_forecast": checks.forecast, "kpi_overview": checks.overview}
        for name, df in frames.items():
            watch.get(name, lambda x: x)(df).write.mode("overwrite").parquet(self.whole(name, load))
        checks.stop_at_violations()
        CE.rollup(star["cells"]).write.mode("overwrite").partitionBy("level").parquet(self.whole("rollup", load))

    def whole(self, name: str, load: int | None = None) -> str:
        """Where a table written whole lies as of a load, the last one if none is given."""
        return f"{self.root}/{name}/load={self.marks.last() if load is None else load}"

    def tables(self) -> dict[str, Callable[[], DataFrame]]:
        """Readers of what is published by key bucket, as of the last load."""
        n = self.marks.last()
        out = {"fact_patient_enrollment": lambda: self.fact.read(n), "cells": lambda: self.cells.read(n)}
        return out | {name: (lambda t=t: t.read(n)) for name, t in self.marts.items()}
