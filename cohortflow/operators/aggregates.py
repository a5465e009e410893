"""A-03 … A-10, W-02: aggregate building blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import pct


def count_if(cond: Column) -> Column:
    """A-03: ``count(*) FILTER (WHERE cond)`` as bigint (NULL conditions do not count)."""
    return F.count_if(F.coalesce(cond, F.lit(False))).cast("bigint")


def avg_if(value: Column, cond: Column, scale: int | None = 1) -> Column:
    """A-04: average of ``value`` over rows where ``cond``, rounded (half away from zero)."""
    a = F.avg(F.when(cond, value))
    return F.round(a, scale).cast("double") if scale is not None else a


def share_of_partition(df: DataFrame, value_col: str, partition_cols: Sequence[str], out_col: str,
                       scale: int = 1) -> DataFrame:
    """W-02: ``100 * value / sum(value) over (partition by …)`` on an already aggregated frame.

    The window runs on the aggregate (one row per group), never on raw rows."""
    total = F.sum(F.col(value_col)).over(Window.partitionBy(*partition_cols))
    return df.withColumn(out_col, pct(F.col(value_col), total, scale))


def groups_with_more_than(df: DataFrame, key: Sequence[str], n: int = 1, count_col: str = "versions") -> DataFrame:
    """A-09: ``GROUP BY key HAVING count(*) > n``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > n)


def sum_by(df: DataFrame, key: Sequence[str], value_col: str, out_col: str, money: bool = True) -> DataFrame:
    """A-06: per-key sum, written to run before a join (Catalyst will not push it through one)."""
    v = F.col(value_col).cast("decimal(18,2)") if money else F.col(value_col)
    return df.groupBy(*key).agg(F.sum(v).cast("double").alias(out_col))
