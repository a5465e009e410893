"""Landing CSV scans and table sinks: S-01, S-05, S-07, S-09, S-11."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import table_exists
from .schemas import TYPED, landing_schema


def write_landing(df: DataFrame, path: str) -> None:
    """Land an extract as header CSV (what a source system delivers), a file for each of its
    partitions. Strings as written."""
    (df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
       .write.mode("overwrite").option("header", True).csv(path))


def read_landing(spark: SparkSession, path: str, source: str) -> DataFrame:
    """S-01: batch scan of header CSV with the declared text schema.

    ``enforceSchema=false`` checks every file's header against the declared names, so a file
    whose columns moved fails loudly instead of loading shifted values."""
    return (spark.read.schema(landing_schema(source)).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").csv(path))


def headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header) of every CSV file below ``path``: the file's first line. The lines of a file's
    first block are numbered in reading order, and an aggregate keeps the first; one row per file."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    first = lines.filter(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), F.col("value"), F.monotonically_increasing_id().alias("n"))
    return first.groupBy("file").agg(F.min_by("value", "n").alias("header"))


def header_names(header: str) -> list[str]:
    """Column names of a header line: quotes and a byte order mark taken off."""
    return [c.strip() for c in next(csv.reader([header.lstrip("\ufeff")]))]


def evolved_columns(kinds: Sequence[str], declared: Sequence[str], key: str, what: str) -> tuple[list[str], list[dict[str, int]]]:
    """(all columns, and of each header its columns' positions): declared columns first, new ones after them
    in the order of the headers. Names match whatever their case; a header without the key raises."""
    by_lower = {n.lower(): n for n in declared}
    places = []
    for header in kinds:
        names = [by_lower.get(n.lower(), n) for n in header_names(header)]
        if key not in names:
            raise ValueError(f"{what}: a file's header lacks {key}: {header}")
        places.append({n: k for k, n in enumerate(names)})
    return [*declared, *dict.fromkeys(n for at in places for n in at if n not in declared)], places


def by_position(rows: DataFrame, columns: Sequence[str], places: Sequence[dict[str, int]], keep: Sequence[str] = ()) -> DataFrame:
    """Pick the named columns of rows (c0, c1, …, version), ``version`` being the number of their header."""
    picked = []
    for c in columns:
        value = F.lit(None).cast("string")
        for v, at in enumerate(places):
            if c in at:
                value = F.when(F.col("version") == v, F.col(f"c{at[c]}")).otherwise(value)
        picked.append(value.alias(c))
    return rows.select(*picked, *keep)


def positional_schema(places: Sequence[dict[str, int]]) -> T.StructType:
    return T.StructType([T.StructField(f"c{k}", T.StringType(), True) for k in range(max(max(at.values()) for at in places) + 1)])


def read_evolving(spark: SparkSession, path: str, source: str, key: str | None = None, multi_line: bool = False) -> DataFrame:
    """S-05: additive schema evolution in one scan. The files are parsed by position, however many header
    versions there are; each row's file names its header, and columns are picked by the positions that the
    header gives them (missing columns are NULL). Declared columns come first, new columns after them. Names
    match whatever their case, order or quoting; a file whose header lacks the key column raises.

    The headers come from a scan of their own, which takes lines alone and keeps one a file; only the
    distinct ones reach the driver. A record is one line unless ``multi_line`` says that quoted
    fields may hold line feeds (files are then not split)."""
    declared = [n for n, _ in TYPED[source]]
    found = headers(spark, path)
    kinds = sorted(r["header"] for r in found.select("header").distinct().collect())  # one row a schema version
    if not kinds:
        return spark.createDataFrame([], landing_schema(source))
    columns, places = evolved_columns(kinds, declared, key or declared[0], path)
    rows = (spark.read.schema(positional_schema(places)).option("header", True).option("enforceSchema", True).option("multiLine", multi_line)
            .option("recursiveFileLookup", "true").csv(path))
    if len(kinds) == 1:
        return by_position(rows.withColumn("version", F.lit(0)), columns, places)
    version = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("header")).cast("int") - 1
    rows = rows.withColumn("file", F.col("_metadata.file_path")).join(found.select("file", version.alias("version")), "file")
    return by_position(rows, columns, places)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """S-07: overwrite one table's folder."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """S-09: create-or-replace a catalog table stored at ``path``."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S-11: ``CREATE TABLE IF NOT EXISTS``: write a typed empty table on first use, then read."""
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)
