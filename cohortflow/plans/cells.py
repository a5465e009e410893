"""Additive states of the enrolment fact: cells, signed changes, and their roll-ups.

A *cell* holds what the KPIs and measures sum, by study, site, race, sex and enrolment date. All of it
adds up, so a changed patient's row is taken out and put in by signed sums (K-01 … K-09 after a load),
and a coarser level is the sum of a finer one. The first enrolment is the least date of a cell that still
has one, so it survives a retraction too.

``Rollup`` is one table of GROUPING SETS over the cells, a partition a level. A measure is answered from
the level with the fewest rows that holds its grouping and filters, else from the fact.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMS = ["study_id", "site_id", "race_ethnicity", "sex", "enrolled_date"]
STATES = ["leads", "consented", "screened", "randomized", "enrolled", "lead_days", "lead_days_n", "screen_days", "screen_days_n"]
CELL_SCHEMA = T.StructType([*[T.StructField(c, T.DateType() if c == "enrolled_date" else T.StringType()) for c in DIMS], *[T.StructField(c, T.LongType()) for c in STATES]])
LEVELS = {
    "study": ["study_id"],
    "study_race": ["study_id", "race_ethnicity", "sex"],
    "study_site": ["study_id", "site_id"],
    "study_day": ["study_id", "enrolled_date"],
    "site_day": ["study_id", "site_id", "enrolled_date"],
    "site_race": ["study_id", "site_id", "race_ethnicity", "sex"],
    "cell": DIMS,
}


def total(state: str, where: Column | None = None) -> Column:
    """The sum of a state over the rows where a condition holds; 0 over none."""
    return F.coalesce(F.sum(F.col(state) if where is None else F.when(where, F.col(state))), F.lit(0)).cast("bigint")


def first_enrolled() -> Column:
    return F.min(F.when(F.col("enrolled") > 0, F.col("enrolled_date")))


def with_states(fact: DataFrame) -> DataFrame:
    """The fact's rows with their states beside their own columns."""
    def has(c: str) -> Column:
        return F.col(c).isNotNull().cast("long")

    enrolled = F.coalesce(F.col("is_enrolled"), F.lit(False))
    lead = F.when(enrolled, F.col("days_lead_to_enrolled")).cast("long")
    screen = F.when(F.col("screened_date").isNotNull(), F.col("days_screened_to_randomized")).cast("long")
    return fact.select("*", F.lit(1).cast("long").alias("leads"), *[has(f"{c}_date").alias(c) for c in ("consented", "screened", "randomized")],
                       enrolled.cast("long").alias("enrolled"), F.coalesce(lead, F.lit(0)).cast("long").alias("lead_days"), lead.isNotNull().cast("long").alias("lead_days_n"),
                       F.coalesce(screen, F.lit(0)).cast("long").alias("screen_days"), screen.isNotNull().cast("long").alias("screen_days_n"))


def cells(fact: DataFrame) -> DataFrame:
    return with_states(fact).groupBy(*DIMS).agg(*[F.sum(c).alias(c) for c in STATES])


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Signed cells: what new fact rows add less what old ones take away; cells that stay as they are have no row."""
    both = cells(new).unionByName(cells(old).select(*DIMS, *[(-F.col(c)).alias(c) for c in STATES]))
    some = F.lit(False)
    for c in STATES:
        some = some | (F.col(c) != 0)
    return both.groupBy(*DIMS).agg(*[F.sum(c).alias(c) for c in STATES]).where(some)


def added(stored: DataFrame, change: DataFrame) -> DataFrame:
    """Stored cells after signed changes; empty cells go."""
    return stored.unionByName(change).groupBy(*DIMS).agg(*[F.sum(c).alias(c) for c in STATES]).where(F.col("leads") != 0)


def rollup(cell: DataFrame) -> DataFrame:
    """All levels in one aggregate: (level, dims, states, first_enrolled); a dim that a level leaves out is NULL."""
    bits = {name: sum(1 << (len(DIMS) - 1 - k) for k, d in enumerate(DIMS) if d not in dims) for name, dims in LEVELS.items()}
    level = F.when(F.lit(False), F.lit(""))
    for name, b in bits.items():
        level = level.when(F.grouping_id() == b, F.lit(name))
    sets = [[F.col(d) for d in dims] for dims in LEVELS.values()]
    return cell.groupingSets(sets, *[F.col(d) for d in DIMS]).agg(level.alias("level"), *[F.sum(c).alias(c) for c in STATES], first_enrolled().alias("first_enrolled"))


class Rollup:
    """The written roll-up of some cells."""

    SCHEMA = T.StructType([*CELL_SCHEMA.fields, T.StructField("first_enrolled", T.DateType()), T.StructField("level", T.StringType())])

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        # one row a level
        self.sizes = {r["level"]: r["n"] for r in self._read().groupBy("level").agg(F.count("*").alias("n")).collect()}

    @classmethod
    def write(cls, cell: DataFrame, path: str) -> Rollup:
        rollup(cell).write.mode("overwrite").partitionBy("level").parquet(path)
        return cls(cell.sparkSession, path)

    def _read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def choose(self, columns: Iterable[str]) -> str | None:
        """The level with the fewest rows that holds the columns; none if no level does."""
        fit = [(self.sizes.get(name, 0), k, name) for k, (name, dims) in enumerate(LEVELS.items()) if set(columns) <= set(dims)]
        return min(fit)[2] if fit else None

    def level(self, name: str) -> DataFrame:
        return self._read().where(F.col("level") == name).select(*LEVELS[name], *STATES, "first_enrolled")


def states_of(star: dict) -> DataFrame:
    """Rows to sum: the star's cells where it has them, else its fact."""
    return star["cells"] if "cells" in star else with_states(star["fact_patient_enrollment"])
