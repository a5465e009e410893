"""Mergeable distinct states (A-05, X-08, X-09, K-04): bitmaps over dictionary numbers.

Distinct counts don't add up, bitmaps do. ``states`` keeps, by study, site and enrolment week, the
patients as bitmaps of their numbers in a dictionary; any filter and grouping over study, site and
week then counts distinct patients, sites and studies by OR, without the fact. A bitmap covers
32,768 numbers (Spark's bitmap functions), so a group's patients are as many rows as they need chunks.

Numbers are given once: a new value gets the next free number of its hash bucket, the numbers of
bucket b being b, b + B, b + 2B, ... So the dictionary grows by appending, each bucket on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import week_start

#: Hash buckets of a dictionary: fixed for its life.
BUCKETS = 64
KEYS = ["study_id", "site_id", "week_start"]


def numbered(values: DataFrame, known: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(value, number) of ``known`` and of the further distinct non-null values of a one-column table."""
    (name,) = values.columns
    new = values.select(F.col(name).alias("value")).where(F.col("value").isNotNull()).distinct()
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets))
    if known is None:
        new = new.withColumn("_used", F.lit(0).cast("long"))
    else:
        used = known.groupBy(bucket.alias("_b")).agg(F.count("*").alias("_used"))
        new = new.join(known, "value", "left_anti").withColumn("_b", bucket).join(used, "_b", "left").select("value", F.coalesce("_used", F.lit(0)).alias("_used"))
    place = F.row_number().over(Window.partitionBy(bucket).orderBy("value")) - 1
    out = new.select("value", (bucket + (F.col("_used") + place) * buckets).cast("long").alias("number"))
    return out if known is None else known.unionByName(out)


def _bits(number: Column) -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position(number))


def states(fact: DataFrame, patients: DataFrame) -> DataFrame:
    """(study_id, site_id, week_start, chunk, patients): the patients of the fact by their numbers; the week
    is that of the enrolment, NULL without one. A patient's rows meet its number in one join."""
    rows = fact.select("patient_id", "study_id", "site_id", week_start("enrolled_date").alias("week_start"))
    rows = rows.join(patients, F.col("patient_id") == F.col("value"), "left")
    chunk = F.bitmap_bucket_number("number")
    # a fact row without a patient keeps its study and site in the states, with no bit
    return rows.groupBy(*KEYS, chunk.alias("chunk")).agg(_bits(F.col("number")).alias("patients"))


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """The states of two sets of rows taken together."""
    return a.unionByName(b).groupBy(*KEYS, "chunk").agg(F.bitmap_or_agg("patients").alias("patients"))


def distinct_patients(state: DataFrame, group_by: Sequence[str], out: str = "patients") -> DataFrame:
    """Distinct patients by group: chunks are OR-ed, then counted."""
    chunks = state.groupBy(*group_by, "chunk").agg(F.bitmap_or_agg("patients").alias("patients"))
    return chunks.groupBy(*group_by).agg(F.coalesce(F.sum(F.bitmap_count("patients")), F.lit(0)).cast("long").alias(out))


def distinct_values(state: DataFrame, group_by: Sequence[str], column: str, numbers: DataFrame, out: str) -> DataFrame:
    """Distinct values of a key column (sites, studies) by group, as bitmaps of their numbers. The distinct
    keys of the states are small beside the fact; NULL is no value."""
    keys = state.select(*dict.fromkeys([*group_by, column])).distinct()
    keys = keys.join(numbers.select(F.col("value").alias(column), "number"), column, "left")
    chunks = keys.groupBy(*group_by, F.bitmap_bucket_number("number").alias("chunk")).agg(_bits(F.col("number")).alias("bits"))
    return chunks.groupBy(*group_by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(out))
