"""Spark session and shared-folder helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session settings every plan relies on: UTC dates, AQE (coalescing, skew-join split, runtime
# broadcast of small sides) and Arrow for the few pandas hops.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(shuffle_bytes: float, target_partition_bytes: int = 256 << 20,
                 executors: int = 1000, cores_per_executor: int = 8) -> dict:
    """Spill-aware sizing for a large cluster (e.g. 100 TB input on 1000 executors).

    The initial shuffle partition count splits the largest exchange into pieces of about
    ``target_partition_bytes`` (AQE then coalesces small stages and splits skewed partitions) and
    is never below the number of task slots. Scans split files at the same size. Runtime
    broadcast only under a measured bound. Example: 30 TB of shuffle at 256 MB -> ~123 000
    partitions. Pass the result as ``extra`` to ``build_session`` or to the cluster's config."""
    slots = executors * cores_per_executor
    parts = max(slots, int(shuffle_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    }


def build_session(master: str | None = None, app: str = "cohortflow", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in _RUNTIME_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply runtime settings that results depend on (UTC session time zone, AQE)."""
    for k, v in _RUNTIME_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - static conf on some deployments
            pass
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and written state.

    Read from ``spark.checkpoint.dir``; only where a session on the local master has none (tests)
    a fresh scratch folder is created and registered. On a cluster that is an error: each
    executor would write to its own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext: the conf is all there is
        sc = None
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cohortflow-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A unique folder below the shared folder (never a machine-local temp dir on a cluster)."""
    import uuid

    base = shared_dir(spark)
    return "/".join([base, "cohortflow", *parts, uuid.uuid4().hex])


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True when a table can be read at ``path`` (any file system scheme)."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.format(fmt).load(path).schema
        return True
    except AnalysisException:
        return False
