"""A sieve of fixed size: one bit for each value of a hash taken modulo ``BITS``. It is broadcast
(``BITS`` / 8 bytes, 4 MB, whatever the data) to keep rows that can't have a partner out of a
shuffle; a row that passes may still have none, so the join after it stays what decides. As the data
grow more rows pass, which costs time and changes no result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25
_PER_ROW = 1 << 15  # bits that bitmap_construct_agg holds


def sieve(keys: DataFrame, key: Column) -> DataFrame:
    """(sieve_row, sieve_bits) of the keys' hashes."""
    bit = F.pmod(key, F.lit(BITS))
    rows = keys.select((bit / _PER_ROW).cast("int").alias("sieve_row"), (bit % _PER_ROW).alias("bit"))
    return rows.groupBy("sieve_row").agg(F.bitmap_construct_agg("bit").alias("sieve_bits"))


def parted(df: DataFrame, key: Column, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``df`` whose hash may be among the sieve's keys, rows whose hash isn't), with the
    columns of ``df``. A null hash isn't among them."""
    bit = F.pmod(key, F.lit(BITS))
    at = (bit % _PER_ROW).cast("int")
    byte = F.conv(F.hex(F.substr("sieve_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    one = F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1, F.lit(False))
    rows = df.withColumn("sieve_at", (bit / _PER_ROW).cast("int")).join(F.broadcast(bits), F.col("sieve_at") == F.col("sieve_row"), "left")
    return rows.where(one).select(*df.columns), rows.where(~one).select(*df.columns)


def sifted(df: DataFrame, key: Column, bits: DataFrame) -> DataFrame:
    """The rows of ``df`` whose hash may be among the sieve's keys."""
    return parted(df, key, bits)[0]
