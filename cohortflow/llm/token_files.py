"""Token-ID output (operator 4): flat files of unsigned token ids, and 64-bit document offsets.

``write_token_files`` deals the documents by ranges of (doc_id, hash of the text), sorts each
range, encodes it and lets every task write one shard of two files below ``folder``:

* ``<shard>-<attempt>.ids``: the ids of its documents one after another, little-endian unsigned
  integers of 16 bits where the vocabulary has at most 65,536 entries, else of 32;
* ``<shard>-<attempt>.idx``: pairs of little-endian 64-bit integers (doc_id, end of the document
  counted in ids from the shard's start).

The manifest, a Parquet table with one row a shard, names the files of the attempt that counted, so
a lost executor or a repeated task leaves at most files that nothing names. Each shard's base is the
prefix sum of the id counts of the shards before it. ``read_token_files`` maps the files into memory
(or reads them, where the folder isn't a mounted file system) and returns one row per document.

Defined cases: a null text is an empty one (its only id is the end id); a null doc_id sorts first
and is kept as -2**63 in the file; rows of equal doc_id are ordered by the text's hash and stay rows
of their own; equal rows stay too; an empty table gives no shard and no row; other columns of any
name are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm.common import query, table, written
from cohortflow.llm.tokens import encoder, vocab_path
from cohortflow.session import scratch_path

NULL_ID = -(1 << 63)
END_ID = 1
MANIFEST = "shard int, ids_file string, idx_file string, bits int, n_docs long, n_ids long"


def as_uri(folder: str) -> str:
    """The folder with its scheme, as both Spark and pyarrow take it."""
    folder = folder.rstrip("/")
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


def write_token_files(docs: DataFrame, folder: str, vocab: str | None = None, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards; the manifest (written below ``folder``) with ``base``, the number of ids in
    all shards before. The prefix sum runs over the manifest, whose size is the number of tasks."""
    spark, vocab = docs.sparkSession, vocab or vocab_path()
    folder = as_uri(folder)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        enc, task = encoder(vocab), TaskContext.get()
        kind, bits = ("<u2", 16) if max(enc.size - 1, end_id) < 1 << 16 else ("<u4", 32)
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        stem = f"{task.partitionId():06d}-{uuid.uuid4().hex}"
        n_docs = n_ids = 0
        with fs.open_output_stream(f"{path}/{stem}.ids") as ids_out, fs.open_output_stream(f"{path}/{stem}.idx") as idx_out:
            while first is not None:
                keys = [NULL_ID if k is None else k for k in first.column(0).to_pylist()]
                index = np.empty((len(keys), 2), "<i8")
                index[:, 0] = keys
                for i, ids in enumerate(enc.encode(first.column(1).to_pylist())):
                    ids_out.write(np.append(ids, np.uint32(end_id)).astype(kind).tobytes())
                    n_ids += len(ids) + 1
                    index[i, 1] = n_ids
                idx_out.write(index.tobytes())
                n_docs += len(keys)
                first = next((b for b in batches if b.num_rows), None)
        yield pa.RecordBatch.from_pylist([{"shard": task.partitionId(), "ids_file": f"{stem}.ids", "idx_file": f"{stem}.idx", "bits": bits, "n_docs": n_docs, "n_ids": n_ids}],
                                         pa.schema([("shard", pa.int32()), ("ids_file", pa.string()), ("idx_file", pa.string()), ("bits", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("h"))
    dealt = own.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    manifest = written(dealt.mapInArrow(shard, MANIFEST), "token-manifest")
    # one small row a task: the only rows that meet in one task
    base = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    manifest.withColumn("base", base.cast("long")).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def map_file(fs: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start (ids before it in all shards), n_tokens and
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers)."""
    folder = as_uri(folder)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                index = map_file(fs, f"{path}/{row['idx_file']}", "<i8").reshape(-1, 2)
                ids = map_file(fs, f"{path}/{row['ids_file']}", "<u2" if row["bits"] == 16 else "<u4")
                if len(index) != row["n_docs"] or len(ids) != row["n_ids"]:
                    raise OSError(f"{row['ids_file']} isn't whole")
                at = 0
                for k in range(0, len(index), 5000):
                    part = np.array(index[k : k + 5000])
                    ends = part[:, 1]
                    starts = np.append(at, ends[:-1])
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(part[:, 0], mask=part[:, 0] == NULL_ID), pa.array(starts + row["base"]), pa.array(ends - starts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                    at = int(ends[-1])

    manifest = spark.read.parquet(f"{folder}/manifest").select("ids_file", "idx_file", "bits", "n_docs", "n_ids", "base")
    # a shard a task: as many partitions as there may be tasks, dealt round
    dealt = manifest.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return dealt.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "llm", "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder)
    return read_token_files(spark, folder)
