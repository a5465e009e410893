"""S-03 ingest stamp and S-12 processed-file ledger."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import ts_lit
from .schemas import INGEST_TS, SOURCE_FILE


def stamp(df: DataFrame, ingest_ts: _dt.datetime | Column, source_file: str | Column) -> DataFrame:
    """Add ``_ingest_ts`` (one value per load) and ``_source_file``."""
    ts = ingest_ts if isinstance(ingest_ts, Column) else ts_lit(ingest_ts)
    sf = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return df.withColumn(INGEST_TS, ts).withColumn(SOURCE_FILE, sf)


INGEST_DATE = "_ingest_date"


def stamp_from_metadata(df: DataFrame) -> DataFrame:
    """Stamp in a file scan or stream: load time, its date (the Bronze partition column, so
    mark filters prune old partitions) and the file each row came from."""
    return (df.withColumn(INGEST_TS, F.current_timestamp()).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
            .withColumn(INGEST_DATE, F.to_date(F.col(INGEST_TS))))


def file_ledger(spark: SparkSession, landing_dir: str, bronze: DataFrame, glob: str = "*.csv") -> DataFrame:
    """S-12: files seen in the landing folder vs. files loaded into Bronze.

    The ``binaryFile`` listing reads only path, size and modification time (the content column
    is pruned), and Bronze contributes its distinct ``_source_file`` values."""
    seen = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .load(landing_dir).select("path", "length", "modificationTime"))
    loaded = bronze.select(F.col(SOURCE_FILE).alias("path")).distinct().withColumn("loaded", F.lit(True))
    return seen.join(loaded, "path", "left").withColumn("loaded", F.coalesce(F.col("loaded"), F.lit(False)))
