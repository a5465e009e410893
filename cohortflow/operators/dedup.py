"""W-01 first row per key, and the bounded first-k per group.

``first_per_key`` is an aggregate (min of a struct that leads with the ordering columns), not a
window: Spark plans it as a partial aggregate before the shuffle and a final one after, so a key
holding a third of all rows is reduced map-side to one row per task before any exchange. With
strings in the struct both are sort aggregates (docs/PLANS.md).
Ties on the ordering columns are broken by the remaining columns, so the result is
deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], descending: bool = False) -> DataFrame:
    """Keep one row per ``key``: the smallest (or largest) by ``order``, then by the other columns."""
    key = list(key)
    order = [c for c in order if c not in key]
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    agg = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(*key).agg(agg.alias("_first"))
    return out.select(*[F.col(c) for c in key], *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(*df.columns)


def last_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_per_key(df, key, order, descending=True)


def first_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k inside each group (``row_number`` over ``order``).

    Spark turns ``row_number() <= k`` into a per-partition group limit ahead of the shuffle
    (WindowGroupLimit, partial + final), so at most k rows per group leave each map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def removed_duplicates(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows that ``first_per_key`` drops (the duplicates), for lineage traces."""
    kept = first_per_key(df, key, order)
    return df.exceptAll(kept)  # multiset difference; NULLs compare equal in set operations
