"""A-01 conditional-min pivot and A-02 deterministic representative value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_date_columns(pivot_col: str, values: Sequence[str], date_col: str, suffix: str = "_date") -> list[Column]:
    """One ``min(CASE WHEN pivot = v THEN date END)`` aggregate per value, named ``v + suffix``."""
    return [F.min(F.when(F.col(pivot_col) == v, F.col(date_col))).alias(f"{v}{suffix}") for v in values]


def representative(value_col: str, order_cols: Sequence[str]) -> Column:
    """A-02: the value of the row that sorts first by ``order_cols`` then by the value itself
    (a deterministic ``any_value``)."""
    packed = F.struct(*[F.col(c) for c in order_cols], F.col(value_col).alias("_v"))
    return F.min(packed)["_v"]


def milestone_pivot(events: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str], date_col: str,
                    carry: dict[str, Column] | None = None) -> DataFrame:
    """Long events -> one row per key with the first date of every pivot value.

    One hash aggregate with partial aggregation; no per-key sort, no Spark ``pivot`` (which
    would need the distinct values first). ``carry`` adds more aggregates (e.g. representative)."""
    aggs = list((carry or {}).items())
    cols = [c.alias(n) for n, c in aggs] + first_date_columns(pivot_col, values, date_col)
    return events.groupBy(*keys).agg(*cols)
