"""Keyed state laid out by key bucket and load (M-01, M-03, M-06, M-07).

A table is plain Parquet under ``<path>/bucket=<b>/load=<n>``, ``b`` being a hash of the key modulo a
fixed number of buckets. A load reads and writes the buckets that its keys touch and no others, so its
cost follows the batch, not the table. The rows of a bucket are those of its greatest load: which
partitions to read comes from the partition values alone, and "as of load n" is the same with greater
loads left out. Nothing in a committed partition is ever changed. A marker row (``_marker``) stands in
every partition, so that a bucket which a load leaves empty is known to be empty.

``LoadMarks`` holds the high-water marks, one partition a load, written after the load's state. A load
counts from then on: readers take the state up to the last load with marks. A load that stopped before
is run again under the same number and replaces its own partitions (Spark's dynamic partition
overwrite), and a batch that already has marks is left out. There is one writer at a time, as the
schedule runs one load after another.

Choose the number of buckets for the table's size to come: 100 to 500 MB each. Within a bucket rows are
sorted by key, and the first key column has a Bloom filter, so a lookup reads one bucket's few row groups.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.schemas import WATERMARK_SCHEMA

_PART = re.compile(r"/bucket=(\d+)/load=(\d+)/[^/]*$")
_LOAD = re.compile(r"/load=(\d+)/[^/]*$")


def _files(spark: SparkSession, schema: T.StructType, path: str) -> list[str]:
    """Data files below ``path`` as Spark lists them; no file is opened."""
    try:
        return spark.read.schema(schema).parquet(path).inputFiles()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


class BucketedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], buckets: int):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, list(key), buckets
        self._with_marker = T.StructType([*schema.fields, T.StructField("_marker", T.BooleanType())])
        self._stored = T.StructType([*self._with_marker.fields, T.StructField("bucket", T.IntegerType()), T.StructField("load", T.IntegerType())])

    def bucket(self) -> Column:
        """The bucket of a row with the key's columns."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.key]), F.lit(self.buckets)).cast("int")

    def latest(self, upto: int | None = None) -> dict[int, int]:
        """bucket -> its greatest load (not above ``upto``)."""
        found: dict[int, int] = {}
        for f in _files(self.spark, self._stored, self.path):
            if m := _PART.search(f):
                b, n = int(m[1]), int(m[2])
                if upto is None or n <= upto:
                    found[b] = max(n, found.get(b, n))
        return found

    def read(self, upto: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows as of a load (the last one if none is given), of some buckets or all."""
        latest = self.latest(upto)
        paths = [f"{self.path}/bucket={b}/load={n}" for b, n in sorted(latest.items()) if only is None or b in set(only)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self._with_marker).parquet(*paths).filter(F.col("_marker").isNull()).drop("_marker")

    def lookup(self, value: object, upto: int | None = None) -> DataFrame:
        """The rows of one key (a table of one key column): one bucket is read."""
        (k,) = self.key
        one = self.spark.createDataFrame([(value,)], T.StructType([self.schema[k]])).select(self.bucket()).first()[0]
        return self.read(upto, [one]).filter(F.col(k) == value)

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of a batch's keys: at most ``buckets`` numbers."""
        return sorted(r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect())

    def merge(self, batch: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame], load: int) -> list[int]:
        """Replace the touched buckets by ``apply(their stored rows, batch)`` as load ``load``; the touched buckets."""
        touched = self.touched(batch)
        self.replace(touched, apply(self.read(load - 1, touched), batch), load)
        return touched

    def replace(self, touched: Sequence[int], rows: DataFrame, load: int, watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Write ``rows``, all of these buckets, as what they hold from load ``load`` on. ``watch`` may observe
        them on the way: it gets the rows dealt by bucket, markers (``_marker``) among them."""
        if not touched:
            return
        markers = self.spark.createDataFrame([(b,) for b in touched], "bucket int").withColumn("_marker", F.lit(True))
        rows = rows.select(*self.schema.names).withColumn("bucket", self.bucket()).unionByName(markers, allowMissingColumns=True).withColumn("load", F.lit(load))
        dealt = rows.repartition("bucket")
        dealt = dealt if watch is None else watch(dealt).select(*dealt.columns)
        (dealt.sortWithinPartitions("bucket", *self.key).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").option(f"parquet.bloom.filter.enabled#{self.key[0]}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
         .partitionBy("bucket", "load").parquet(self.path))

    def rows_by_load(self) -> DataFrame:
        """(load, rows): the number of rows in the table as of each load that wrote any, from the row counts of the
        partitions: a bucket's load adds its rows and takes away those of the bucket's load before."""
        if not self.latest():
            return self.spark.createDataFrame([], "load int, rows long")
        parts = self.spark.read.schema(self._stored).parquet(self.path).groupBy("bucket", "load").agg(F.count_if(F.col("_marker").isNull()).alias("n"))
        before = F.coalesce(F.lag("n").over(Window.partitionBy("bucket").orderBy("load")), F.lit(0))
        by_load = parts.select("load", (F.col("n") - before).alias("n")).groupBy("load").agg(F.sum("n").alias("n"))
        # one row a load meets here
        return by_load.select("load", F.sum("n").over(Window.orderBy("load")).alias("rows"))


class LoadMarks:
    """High-water marks as each load left them: (table_name, watermark, batch_id) under ``load=<n>``."""

    SCHEMA = T.StructType([*WATERMARK_SCHEMA.fields, T.StructField("batch_id", T.StringType())])

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._stored = T.StructType([*self.SCHEMA.fields, T.StructField("load", T.IntegerType())])

    def last(self) -> int:
        """The last load with marks; 0 before the first."""
        return max((int(m[1]) for f in _files(self.spark, self._stored, self.path) if (m := _LOAD.search(f))), default=0)

    def has(self, load: int) -> bool:
        return bool(_files(self.spark, self._stored, f"{self.path}/load={load}"))

    def read(self, load: int | None = None) -> DataFrame:
        """(table_name, watermark) after a load, the last one if none is given."""
        load = self.last() if load is None else load
        if not load:
            return self.spark.createDataFrame([], WATERMARK_SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/load={load}").filter(F.col("table_name").isNotNull()).select("table_name", "watermark")

    def loads(self) -> DataFrame:
        """(load, batch_id) of all loads."""
        if not self.last():
            return self.spark.createDataFrame([], "load int, batch_id string")
        return self.spark.read.schema(self._stored).parquet(self.path).select("load", "batch_id").distinct()

    def load_of(self, batch_id: str) -> int | None:
        return self.loads().filter(F.col("batch_id") == batch_id).agg(F.max("load")).first()[0]

    def write(self, marks: DataFrame, load: int, batch_id: str) -> None:
        """One small file, so that a load's marks are there whole or not at all."""
        named = marks.select("table_name", F.col("watermark").cast("timestamp").alias("watermark")).unionByName(
            self.spark.createDataFrame([(None, None)], "table_name string, watermark timestamp"))  # a load without marks counts too
        named.withColumn("batch_id", F.lit(batch_id)).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/load={load}")
