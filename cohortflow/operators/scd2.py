"""M-01 SCD Type 2 apply and M-02 surrogate key, on plain DataFrames (no MERGE needed).

One batch timestamp closes and reopens a changed key in the same pass (the reference's two
statements read two different clock values and lose the reopened row). Change detection is
null-safe (``<=>``) and the batch is made unique per key first (last row by ingest time).

Plan shape, one at every size: closed history rows are passed through untouched (no shuffle); the
current rows meet the batch in one full outer join on the key, where a marker column on each
side says which of them is present; each joined row emits one or two output rows through
``explode`` of a filtered array, so there is no second join and no self-join.

Rows without a key have no identity to version: they take no part (``without_key`` gives them, for
the reject count).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ts_lit
from .dedup import last_per_key

def surrogate_key(key: str | Sequence[str], effective_from: Column) -> Column:
    """M-02: ``sha2(key ~ effective_from)``, to the microsecond: stable across replays (unlike ``uuid()``)."""
    keys = [key] if isinstance(key, str) else list(key)
    parts = [F.col(k).cast("string") for k in keys] + [F.date_format(effective_from, "yyyy-MM-dd HH:mm:ss.SSSSSS")]
    return F.sha2(F.concat_ws("~", *parts), 256)


def changed(tracked: Sequence[str], left: str = "c", right: str = "s") -> Column:
    cond = F.lit(False)
    for c in tracked:
        cond = cond | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def scd2_apply(dim: DataFrame, batch: DataFrame, key: str, attributes: Sequence[str], tracked: Sequence[str],
               batch_ts: _dt.datetime | Column, sk_col: str = "patient_sk", order_col: str | None = "_ingest_ts") -> DataFrame:
    """Apply one batch to an SCD2 table with columns
    ``sk, key, *attributes, effective_from, effective_to, is_current``.

    * key not current in ``dim``                → insert a current version
    * key current, a tracked attribute changed  → close it at ``batch_ts`` and open a new version
    * key current, nothing tracked changed      → keep (untracked changes are ignored)
    """
    ts = batch_ts if isinstance(batch_ts, Column) else ts_lit(batch_ts)
    cols = [sk_col, key, *attributes, "effective_from", "effective_to", "is_current"]
    src_cols = [key, *attributes] + ([order_col] if order_col and order_col in batch.columns else [])
    src = batch.select(*src_cols).filter(F.col(key).isNotNull())
    if order_col and order_col in src.columns:
        src = last_per_key(src, [key], [order_col]).drop(order_col)
    else:
        src = last_per_key(src, [key], list(attributes))

    history = dim.filter(~F.col("is_current")).select(*cols)
    current = dim.filter(F.col("is_current")).select(*cols).withColumn("_in_table", F.lit(True))
    src = src.withColumn("_in_batch", F.lit(True))
    j = current.alias("c").join(src.alias("s"), F.col(f"c.{key}") == F.col(f"s.{key}"), "full_outer")

    c_present = F.coalesce("c._in_table", F.lit(False))
    s_present = F.coalesce("s._in_batch", F.lit(False))
    chg = c_present & s_present & changed(tracked)

    kept = F.struct(
        F.col(f"c.{sk_col}").alias(sk_col), F.col(f"c.{key}").alias(key),
        *[F.col(f"c.{a}").alias(a) for a in attributes],
        F.col("c.effective_from").alias("effective_from"),
        F.when(chg, ts).otherwise(F.col("c.effective_to")).alias("effective_to"),
        F.when(chg, F.lit(False)).otherwise(F.col("c.is_current")).alias("is_current"),
    )
    opened = F.struct(
        surrogate_key(f"s.{key}", ts).alias(sk_col), F.col(f"s.{key}").alias(key),
        *[F.col(f"s.{a}").alias(a) for a in attributes],
        ts.alias("effective_from"),
        F.lit(None).cast("timestamp").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    rows = F.array(F.when(c_present, kept), F.when(s_present & (~c_present | chg), opened))
    out = j.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*")
    return history.unionByName(out)


def without_key(batch: DataFrame, key: str) -> DataFrame:
    """Rows of a batch that ``scd2_apply`` leaves out."""
    return batch.filter(F.col(key).isNull())


def scd2_initial(batch: DataFrame, key: str, attributes: Sequence[str], batch_ts: _dt.datetime | Column,
                 sk_col: str = "patient_sk", order_col: str | None = "_ingest_ts", unique: bool = False) -> DataFrame:
    """First load of an SCD2 table: every key opens its first version (no join needed).
    Equal to ``scd2_apply`` on an empty table. ``unique=True`` skips the per-key dedup for a
    batch that is one row per key by construction."""
    ts = batch_ts if isinstance(batch_ts, Column) else ts_lit(batch_ts)
    batch = batch.filter(F.col(key).isNotNull())
    if unique:
        src = batch.select(key, *attributes)
    elif order_col and order_col in batch.columns:
        src = last_per_key(batch.select(key, *attributes, order_col), [key], [order_col]).drop(order_col)
    else:
        src = last_per_key(batch.select(key, *attributes), [key], list(attributes))
    return src.select(
        surrogate_key(key, ts).alias(sk_col), key, *attributes,
        ts.alias("effective_from"), F.lit(None).cast("timestamp").alias("effective_to"), F.lit(True).alias("is_current"))


def empty_like(spark, schema) -> DataFrame:
    """S-11: a typed empty table (what ``CREATE TABLE IF NOT EXISTS`` gives on first run)."""
    return spark.createDataFrame([], schema)


def current_view(dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P-08 / D-03: current versions, explicit column list."""
    return dim.filter(F.col("is_current")).select(*columns)
