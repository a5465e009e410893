"""Calendar dimension (F-05, F-06, D-05)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scalar import date_lit


def date_dim(spark: SparkSession, start: _dt.date, end: _dt.date) -> DataFrame:
    """One row per day in [start, end]: date_key, year, month, day, ISO week, full day name.

    Built with ``spark.range`` over the day offsets, so the rows are generated in parallel
    partitions rather than as one exploded array in a single task.
    """
    n_days = (end - start).days + 1
    n_parts = max(1, min(64, n_days // 4096 + 1))
    d = spark.range(0, n_days, 1, n_parts).select(F.date_add(date_lit(start), F.col("id").cast("int")).alias("date_key"))
    return d.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.dayofmonth("date_key").alias("day"),
        F.weekofyear("date_key").alias("week"),
        F.date_format("date_key", "EEEE").alias("day_name"),
    )
