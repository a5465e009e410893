"""Token counts through a digest cache (operator 12).

Every text has a content digest: SHA-256 of its content in a normal form that can't change its
token count. The cache is a Parquet table of (digest, n_tokens) below ``folder/tokenizer=<digest of
library, version and vocabulary file>``, so a changed vocabulary or library never meets old counts.
One run

1. writes (doc_id, n_bytes, digest) of all documents, a small table without texts;
2. joins the distinct digests to the stored counts: those without one are the misses;
3. deals the texts of misses by digest, one text each (a sieve of fixed size keeps other texts out
   of the exchange, the join after it decides), encodes them and appends the counts to the cache;
4. joins the documents to the counts. Digests with at least one in ``HOT`` of all rows, at most
   ``HOT`` digests, are broadcast, so that copies of one text don't meet in one task.

A run that stops before its append leaves the cache as it was; digests that two runs append at the
same time are stored twice and read once.

Defined cases: a null text is an empty one and has no token; a null doc_id stays null; equal rows
and rows of equal doc_id each give a row; texts that differ only where the normal form is equal
share a count; very long texts are encoded in parts where the vocabulary allows it and whole
otherwise; an empty table gives no row and leaves the cache as it was; other columns of any name are
not read.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import query, table, written
from cohortflow.llm.sieve import sieve, sifted
from cohortflow.llm.tokens import DEFAULT_VOCAB, encoder, vocab_path
from cohortflow.session import scratch_path

LIMIT = 2048
#: A digest with at least this part of all rows counts as hot; there are at most so many of them.
HOT = 1000
CACHE = "digest binary, n_tokens long"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _drops_case_and_space(vocab: str) -> bool:
    return os.path.basename(vocab) == DEFAULT_VOCAB


def normal_form(text: Column, vocab: str) -> Column:
    """The content that counts. The word vocabulary drops white space and case itself: runs of ASCII
    white space become one space, and ASCII letters lower case unless the text may hold a special
    string, which is told apart by case. Under any other vocabulary the text is its own normal form."""
    text = F.coalesce(text, F.lit(""))
    if not _drops_case_and_space(vocab):
        return text
    spaced = F.trim(F.regexp_replace(text, "[ \\t\\n\\x0B\\f\\r]+", " "))
    return F.when(F.contains(spaced, F.lit("<|")), spaced).otherwise(F.translate(spaced, ASCII_UPPER, ASCII_LOWER))


def tokenizer_digest(vocab: str) -> str:
    """Names the tokenizer's version: library, its release, and the bytes of the vocabulary."""
    library = "sentencepiece" if vocab.endswith(".model") else "tokenizers"
    h = hashlib.sha256(f"{library} {importlib.metadata.version(library)}\n".encode())
    with open(vocab, "rb") as f:
        while part := f.read(1 << 20):
            h.update(part)
    return h.hexdigest()[:32]


_COUNTERS: dict[str, Callable[[list[str]], list[int]]] = {}


def counter(vocab: str) -> Callable[[list[str]], list[int]]:
    """The worker's function from texts to token counts."""
    if vocab not in _COUNTERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if vocab.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=vocab)
            _COUNTERS[vocab] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        elif _drops_case_and_space(vocab):
            _COUNTERS[vocab] = lambda texts: [len(x) for x in encoder(vocab).encode(texts)]
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(vocab)
            tok.no_truncation()
            tok.no_padding()
            _COUNTERS[vocab] = lambda texts: [len(e.ids) for t in texts for e in tok.encode_batch([t], add_special_tokens=False)]
    return _COUNTERS[vocab]


def _encoded(texts: DataFrame, vocab: str) -> DataFrame:
    """(digest, n_tokens) of rows (digest, content)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = counter(vocab)(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return texts.select("digest", "content").mapInArrow(count, CACHE)


def stored_counts(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """The counts of one tokenizer, each digest once."""
    return spark.read.schema(CACHE).parquet(_version_folder(spark, folder, version)).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _version_folder(spark: SparkSession, folder: str, version: str) -> str:
    path = f"{folder.rstrip('/')}/tokenizer={version}"
    # an append of no row makes the folder where it isn't there
    spark.createDataFrame([], CACHE).write.mode("append").parquet(path)
    return path


def count_tokens(docs: DataFrame, folder: str, vocab: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, through the cache in ``folder``, which
    then holds all of their counts."""
    spark, vocab = docs.sparkSession, vocab or vocab_path()
    version = tokenizer_digest(vocab)
    path = _version_folder(spark, folder, version)
    content = normal_form(F.col(text_col), vocab)
    texts = docs.select(content.alias("content")).select(F.unhex(F.sha2("content", 256)).alias("digest"), "content")
    keyed = written(docs.select(F.col(id_col).alias("doc_id"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"),
                                F.unhex(F.sha2(content, 256)).alias("digest")), "token-digests")

    copies = written(keyed.groupBy("digest").agg(F.count("*").alias("copies")), "token-copies")
    missing = written(copies.join(stored_counts(spark, folder, version), "digest", "left_anti").select("digest"), "token-misses")
    likely = sifted(texts, F.xxhash64("digest"), sieve(missing, F.xxhash64("digest")))
    one_each = likely.groupBy("digest").agg(F.first("content").alias("content")).join(missing, "digest", "left_semi")
    _encoded(one_each, vocab).write.mode("append").parquet(path)

    counts = stored_counts(spark, folder, version)
    total = copies.agg(F.sum("copies")).first()[0] or 0
    hot = F.broadcast(copies.where(F.col("copies") * HOT >= F.lit(total)).select("digest"))
    of_hot = keyed.join(F.broadcast(counts.join(hot, "digest", "left_semi")), "digest")
    of_rest = keyed.join(hot, "digest", "left_anti").join(counts, "digest")
    both = of_hot.select("doc_id", "n_bytes", "n_tokens").unionByName(of_rest.select("doc_id", "n_bytes", "n_tokens"))
    return both.withColumn("over_limit", F.col("n_tokens") > limit)


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents through a cache that starts empty, so that every run does the whole work."""
    return count_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "llm", "token-cache"))
