"""T-03: incremental Silver from the Bronze stream, with keyed state kept by Spark.

The first event of each key is a streaming aggregate, ``groupBy(key).agg(min(struct))``, whose state
lies in the RocksDB state store: a micro-batch reads its own rows and the state of their keys, and
never Silver. In update mode it emits the keys it touched; of these only the changed ones, whose
first event arrived in this batch, are written, to ``batch=<id>``. ``foreachBatch`` may run a batch
twice: it then replaces that one partition by the same rows. The first event of a key only ever moves
earlier, so Silver is the minimum by key over the written changes, in any order.

The state holds one row a key for good, as Silver does: a late event may be earlier than any before.
The number of its partitions is fixed by ``spark.sql.shuffle.partitions`` of the first run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.scalar import ts_lit
from ..operators.dedup import first_per_key
from ..plans import silver as SV
from ..sources.landing import create_if_absent
from ..sources.quarantine import wellformed
from ..sources.schemas import BRONZE_META, CORRUPT, SILVER_FUNNEL_SCHEMA, landing_schema

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
ORDER = ["event_date", "study_id", "site_id"]
CHANGES_SCHEMA = T.StructType([*SILVER_FUNNEL_SCHEMA.fields, T.StructField("_ingest_ts", T.TimestampType()), T.StructField("batch", T.LongType())])


def bronze_schema(source: str) -> T.StructType:
    s = landing_schema(source)
    for n, t in BRONZE_META:
        s = s.add(n, t, True)
    return s.add(CORRUPT, T.StringType(), True).add("_ingest_date", T.DateType(), True)


def first_events(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """key, ``first`` (the first event, of equal ones the one that arrived first) and ``newest`` (the last
    arrival of the key): a streaming aggregate over a stream, a plain one over a table."""
    order = [c for c in ORDER if c not in key]
    first = F.min(F.struct(*order, "_ingest_ts")).alias("first")
    return rows.groupBy(*key).agg(first, F.max("_ingest_ts").alias("newest"))


def run_silver_funnel(spark: SparkSession, bronze_path: str, changes_path: str, checkpoint: str,
                      key: Sequence[str] = C.DEFAULT.funnel_key, max_bytes: str | None = None) -> None:
    """Take all of Bronze that is new, in micro-batches of up to ``max_bytes`` (such as ``10g``) of files."""

    def write_changed(batch: DataFrame, batch_id: int) -> None:
        # written once: two actions on the batch itself would run the stateful plan twice
        touched = f"{checkpoint.rstrip('/')}-touched"
        batch.write.mode("overwrite").parquet(touched)
        kept = spark.read.schema(batch.schema).parquet(touched)
        # every touched key has a row of this batch, and batches come in order of arrival: what
        # arrived at the least of their last arrivals or later came with this batch
        low = kept.agg(F.min("newest")).first()[0]
        if low is not None:
            changed = kept.filter(F.col("first._ingest_ts") >= ts_lit(low)).select(*key, "first.*").withColumn("batch", F.lit(batch_id).cast("long"))
            (changed.select(*CHANGES_SCHEMA.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch").parquet(changes_path))

    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(bronze_schema("funnel_events"))
        if max_bytes:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
        rows = SV.typed_projection(wellformed(reader.parquet(bronze_path)), "funnel_events", keep=["_ingest_ts"])
        q = (first_events(rows, key).writeStream.outputMode("update").foreachBatch(write_changed)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).queryName("silver_funnel").start())
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def changes(spark: SparkSession, changes_path: str) -> DataFrame:
    """The changed keys of each batch, with their first event as of it."""
    return create_if_absent(spark, changes_path, CHANGES_SCHEMA)


def silver_funnel(spark: SparkSession, changes_path: str, key: Sequence[str] = C.DEFAULT.funnel_key) -> DataFrame:
    """Silver as the changes leave it."""
    written = changes(spark, changes_path).select(*SILVER_FUNNEL_SCHEMA.names)
    return first_per_key(written, list(key), [c for c in ORDER if c not in key])


def load_label(col: str = "_source_file") -> F.Column:
    """``load_<n>`` from a landing path such as ``…/funnel_events/load_2/part-….csv``."""
    return F.regexp_extract(F.col(col), r"(load_[0-9]+)", 1)
