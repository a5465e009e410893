"""Bronze ingest with Structured Streaming: S-02, S-03, S-08, T-01, T-02.

Each source is one streaming query: CSV files under ``landing/<source>`` -> Bronze Parquet,
stamped with load time and source file. The checkpoint's file log makes discovery
exactly-once: a re-run reads only files it has not committed. ``availableNow`` processes what
is there and stops, like a scheduled batch job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.bronze import stamp_from_metadata
from ..sources.landing import by_position, evolved_columns, positional_schema
from ..sources.quarantine import checked_schema
from ..sources.schemas import CORRUPT, INGEST_TS, SOURCE_FILE, TYPED


def start_ingest(spark: SparkSession, source: str, landing_glob: str, bronze_path: str, checkpoint: str,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """One run is one batch with one ingest time, so that a load isn't split over several; a caller who
    would rather have several may bound the files of each."""
    reader = (spark.readStream.schema(checked_schema(source)).option("header", True)
              .option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = stamp_from_metadata(reader.csv(landing_glob))
    return (stream.writeStream.format("parquet").outputMode("append").partitionBy("_ingest_date")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .queryName(f"bronze_{source}").start(bronze_path))


def ingest(spark: SparkSession, source: str, landing_glob: str, bronze_path: str, checkpoint: str) -> None:
    """Run one source to completion."""
    q = start_ingest(spark, source, landing_glob, bronze_path, checkpoint)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def ingest_all(spark: SparkSession, specs: list[tuple[str, str, str, str]]) -> None:
    """Parallel source copy: start every source's query, then wait for all of them."""
    qs = [start_ingest(spark, *s) for s in specs]
    errors = []
    for q in qs:
        q.awaitTermination()
        if q.exception():
            errors.append(q.exception())
    if errors:
        raise errors[0]


def ingest_evolving(spark: SparkSession, source: str, landing_glob: str, bronze_path: str, checkpoint: str,
                    key: str | None = None) -> None:
    """S-05 in the ingest: as ``ingest``, but a file may bring further columns, anywhere in its header.

    The stream hands over lines with their file; each file's first line is its header. All lines are
    parsed once, by position, and columns picked by the positions that their file's header gives. A record
    is one line: a quoted field can't hold a line feed here. Bronze gets the columns that a
    batch has (read it with ``read_evolved``). A file without the key column stops the run before
    anything of its batch is written. Each batch is one folder, overwritten if the batch is replayed."""
    declared = [n for n, _ in TYPED[source]]

    def parse(batch: DataFrame, batch_id: int) -> None:
        # numbered and written once: the number tells the header line in both uses of the lines
        numbered = f"{checkpoint.rstrip('/')}-lines"
        batch.withColumn("n", F.monotonically_increasing_id()).write.mode("overwrite").parquet(numbered)
        lines = spark.read.parquet(numbered)
        first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"), F.min("n").alias("at"))
        kinds = sorted(r["header"] for r in first.select("header").distinct().collect())  # one a schema version
        if not kinds:
            return
        columns, places = evolved_columns(kinds, declared, key or declared[0], source)
        version = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("header")).cast("int") - 1
        rows = lines.join(first.select("file", "at", version.alias("version")), "file").filter("n != at")
        fields = ", ".join(f"{f.name} string" for f in positional_schema(places))
        parsed = rows.select(F.from_csv("value", fields).alias("r"), "file", "version").select("r.*", "file", "version")
        stamp = F.lit(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp")
        (by_position(parsed, columns, places, ["file"]).withColumn(INGEST_TS, stamp).withColumnRenamed("file", SOURCE_FILE)
            .write.mode("overwrite").parquet(f"{bronze_path}/_ingest_batch={batch_id}"))

    stream = spark.readStream.text(landing_glob).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    q = (stream.writeStream.foreachBatch(parse).option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .queryName(f"bronze_evolving_{source}").start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def read_evolved(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Bronze as ``ingest_evolving`` left it; columns that a batch lacks are NULL there."""
    return spark.read.option("mergeSchema", True).parquet(bronze_path).drop("_ingest_batch")
