"""Helpers of the llm operators: reading the tables, written intermediate tables, input checks."""

from __future__ import annotations

import os
from collections.abc import Iterable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Query name -> function, and query name -> DuckDB SQL; each module of the subpackage adds its own.
QUERIES: dict = {}
SQL: dict[str, str] = {}


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (on a cluster: from the
    files shipped with the job, which come before)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), root) if x)


def query(fn):
    """Register a query under its function's name."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back: later steps neither compute
    it again nor depend on an executor's disk. Nothing needs its shuffle files then: they go with the
    query, not when the driver next collects garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def only(docs: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns alone, so that further ones can't clash with an operator's own."""
    return docs.select(*[F.col(c) for c in columns])
