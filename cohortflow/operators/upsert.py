"""M-03 keyed first-wins upsert (with the late-arrival fix)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .dedup import first_per_key


def first_wins_upsert(stored: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """New state = first row per key over stored ∪ batch.

    An insert-only merge keeps the stored row even when a late batch brings an earlier event;
    taking the minimum over both keeps "first occurrence" true. Re-applying a batch changes
    nothing (the minimum is idempotent). One plan at every size: one shuffle of stored ∪ batch,
    pre-aggregated map-side."""
    key = list(key)
    return first_per_key(stored.unionByName(batch.select(*stored.columns)), key, order)
