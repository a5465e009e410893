"""Quarantine of what a landing file delivers amiss (S-01, F-01).

A malformed record (too few or too many fields) is kept as text in ``_corrupt_record``, the corrupt-record
column of the CSV reader, and takes no part in Silver. A field that doesn't cast to its declared type
becomes NULL there, as the lenient casts say, and is reported too. ``rejects`` gives both, a row a fault,
with file and reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import typed
from .schemas import CORRUPT, TYPED, landing_schema

MALFORMED, CAST = "malformed", "cast"
COLUMNS = ["source", "file", "reason", "field", "value", "record"]


def checked_schema(source: str) -> T.StructType:
    """The landing schema with the corrupt-record column."""
    return landing_schema(source).add(CORRUPT, T.StringType(), True)


def read_checked(spark: SparkSession, path: str, source: str) -> DataFrame:
    """S-01 with malformed records kept: the declared text columns, ``_corrupt_record`` and ``_source_file``.
    All columns are always parsed: a reader that prunes columns doesn't count a record's fields."""
    return (spark.read.schema(checked_schema(source)).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path).withColumn("_source_file", F.col("_metadata.file_path")))


def wellformed(rows: DataFrame) -> DataFrame:
    """The rows of well-formed records."""
    return rows.filter(F.col(CORRUPT).isNull()) if CORRUPT in rows.columns else rows


def rejects(rows: DataFrame, source: str) -> DataFrame:
    """The faults of some rows, in one pass: (source, file, reason, field, value, record)."""
    def fault(reason: str, when, field=None, value=None, record=None):
        null = F.lit(None).cast("string")
        return F.when(when, F.struct(F.lit(reason).alias("reason"), (null if field is None else F.lit(field)).alias("field"), (null if value is None else value).alias("value"), (null if record is None else record).alias("record")))

    corrupt = F.col(CORRUPT) if CORRUPT in rows.columns else F.lit(None).cast("string")
    faults = [fault(MALFORMED, corrupt.isNotNull(), record=corrupt)]
    for name, kind in TYPED[source]:
        if not isinstance(kind, T.StringType):
            faults.append(fault(CAST, corrupt.isNull() & F.col(name).isNotNull() & typed(name, kind.simpleString()).isNull(), name, F.col(name)))
    found = rows.select(F.lit(source).alias("source"), F.col("_source_file").alias("file"), F.explode(F.filter(F.array(*faults), lambda x: x.isNotNull())).alias("x"))
    return found.select("source", "file", "x.*")
