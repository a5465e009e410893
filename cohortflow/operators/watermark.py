"""High-water marks on ingest time: M-04 read, M-05 advance, P-12 filter, S-04 extract.

A mark on a source's own modified column meets ties: a row that lands later with the very value of the
mark is lost to a strict ``>``. ``extract_ties`` keeps, with the mark, the keys of the rows seen at it;
the next extract takes ``>=`` and leaves those out. What is kept is one value's rows, never the table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import ts_lit
from ..sources.schemas import TIE_MARK_SCHEMA, WATERMARK_SCHEMA


def empty_marks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], WATERMARK_SCHEMA)


def mark_frame(marks: DataFrame, table_name: str, default: _dt.datetime = C.DEFAULT_MARK) -> DataFrame:
    """M-04 as a one-row frame: ``coalesce(max(watermark), default)`` for one table."""
    return (marks.filter(F.col("table_name") == table_name)
            .agg(F.coalesce(F.max("watermark"), ts_lit(default)).alias("watermark"))
            .select(F.lit(table_name).alias("table_name"), "watermark"))


def read_mark(marks: DataFrame, table_name: str, default: _dt.datetime = C.DEFAULT_MARK) -> _dt.datetime:
    """M-04 as a scalar: one aggregated row, read once so the later filter is a literal that
    reaches the Parquet scan (and the partition filter of an ingest-date partitioned Bronze)."""
    return mark_frame(marks, table_name, default).first()["watermark"]


def read_marks(marks: DataFrame, tables: list[str], default: _dt.datetime = C.DEFAULT_MARK) -> dict:
    """M-04 for several tables in one small job."""
    got = {r["table_name"]: r["m"] for r in
           marks.filter(F.col("table_name").isin(tables)).groupBy("table_name").agg(F.max("watermark").alias("m")).collect()}
    return {t: (got.get(t) or default) for t in tables}


def after_mark(df: DataFrame, col: str, mark: _dt.datetime | Column) -> DataFrame:
    """P-12: rows strictly newer than the mark. On Bronze (partitioned by ``_ingest_date``) the
    implied ``_ingest_date >= date(mark)`` is added so whole old partitions are pruned."""
    m = mark if isinstance(mark, Column) else ts_lit(mark)
    out = df.filter(F.col(col) > m)
    if col == "_ingest_ts" and "_ingest_date" in df.columns:
        out = out.filter(F.col("_ingest_date") >= F.to_date(m))
    return out


def until(df: DataFrame, col: str, last: _dt.datetime | Column) -> DataFrame:
    """Rows up to an ingest time; on Bronze the implied ``_ingest_date <= date(last)`` prunes the later partitions."""
    t = last if isinstance(last, Column) else ts_lit(last)
    out = df.filter(F.col(col) <= t)
    if col == "_ingest_ts" and "_ingest_date" in df.columns:
        out = out.filter(F.col("_ingest_date") <= F.to_date(t))
    return out


def advance(marks: DataFrame, table_name: str, new_mark: DataFrame) -> DataFrame:
    """M-05: upsert ``table_name -> max(old, new)``. ``new_mark`` is a one-row frame with column
    ``watermark`` computed from the rows actually read (NULL when none arrived: mark unchanged)."""
    incoming = new_mark.select(F.lit(table_name).alias("table_name"), F.col("watermark").cast("timestamp"))
    return (marks.unionByName(incoming)
            .groupBy("table_name").agg(F.max("watermark").alias("watermark"))
            .filter(F.col("watermark").isNotNull()))


def extract_since(df: DataFrame, col: str, marks: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """S-04: rows with ``col > mark`` ordered by ``col``, and the marks advanced to their max
    (only when rows arrived). The new mark is computed from the same filtered rows."""
    rows = after_mark(df, col, read_mark(marks, source))
    new = rows.agg(F.max(col).alias("watermark"))
    return rows.orderBy(col), advance(marks, source, new)


def empty_tie_marks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TIE_MARK_SCHEMA)


def row_key(key: Sequence[str]) -> Column:
    """A row's key as one string; NULLs stay apart from texts."""
    return F.sha2(F.to_json(F.struct(*key), {"ignoreNullFields": "false"}), 256)


def extract_ties(df: DataFrame, col: str, key: Sequence[str], marks: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """S-04 without loss at ties: the rows with ``col`` above the mark, or equal to it and not seen there,
    ordered by ``col``; and the marks after them, one row (table_name, watermark, row_key) for each row seen
    at the mark. Rows without a value in ``col`` are never taken, as with a plain mark.

    ``key`` names a row: with the identifier alone a row is taken once at each value, with all columns a
    further change at the same value is taken too. The mark is a literal, so it reaches the scan; only
    rows at the mark's value can find a partner in the anti join, whose other side is their keys."""
    own = marks.filter(F.col("table_name") == source)
    mark = own.agg(F.max("watermark")).first()[0]
    kind = df.schema[col].dataType
    rows = df.filter(F.col(col).isNotNull())
    if mark is not None:
        at = ts_lit(mark).cast(kind)
        seen = own.filter(F.col("watermark") == ts_lit(mark)).select(F.col("watermark").cast(kind).alias("_at"), F.col("row_key").alias("_key"))
        rows = rows.filter(F.col(col) >= at).withColumn("_row_key", row_key(key))
        rows = rows.join(seen, (F.col(col) == F.col("_at")) & (F.col("_row_key") == F.col("_key")), "left_anti").drop("_row_key")
    top = rows.agg(F.max(col)).first()[0]
    if top is None:
        return rows.orderBy(col), marks
    new = rows.filter(F.col(col) == F.lit(top)).select(F.lit(source).alias("table_name"), F.col(col).cast("timestamp").alias("watermark"), row_key(key).alias("row_key"))
    # keys seen at an older value are no longer needed; at the same value they add up
    kept = marks.filter((F.col("table_name") != source) | (F.col("watermark") == F.lit(top).cast("timestamp")))
    return rows.orderBy(col), kept.unionByName(new).distinct()
