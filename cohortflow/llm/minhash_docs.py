"""Near-duplicate documents by BagMinHash (operator 5).

A document is the multiset of its five-word shingles. Each shingle of weight w (how often it occurs)
owns Poisson processes over the discretised weights 0, 1, 2, 4, 8, ...: one for each interval up to
the one that holds w, its rate the interval's width. A point has a time, a component and a cell of
its interval; cells above w are not the document's, which halves the last interval as often as
needed. Each component of the signature is the document's earliest point in it. As equal shingles
have equal points, two signatures agree in a component with the probability of the weighted Jaccard
similarity. Points are only made up to a time by which all components have one almost surely, and
further where one has none, so a document costs about as much as its shingles and its signature.

Documents with equal multisets form a class of copies, found by a 128-bit digest; only one of each
goes on. Signatures are banded (16 bands of 4: two documents with similarity 0.8 share a band with
probability 0.9998). In each band's bucket one member, the hub, is compared with all others; pairs are
verified by the exact multiset overlap. Links join components by a distributed union-find. While a
bucket holds several components, it gets other hubs; after ``HUB_ROUNDS`` of these, members of buckets
that still hold several are joined by the rarest of their shingles, early enough in both to reach the threshold, so
that every pair in a bucket is compared, or can't reach the threshold, or is already in one component.

Defined cases: texts of one to four words have one shingle, of all words; null texts and texts
without words have none and are all copies of each other; rows of equal doc_id are documents of their own;
a null doc_id too (a class's id is the least doc_id that isn't null); an empty table gives no row;
other columns of any name are not read (``one_of_each`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import query, table, written
from cohortflow.llm.components import link_buckets
from cohortflow.llm.word_hashes import MUL, in_parts, mixed, ngram_hashes, words_of

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
HUB_ROUNDS = 4
_C = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle of every text, repeated ones too."""
    w = words_of(texts)
    n = np.diff(w.first)
    which = np.repeat(np.arange(len(texts)), n)
    hashes = ngram_hashes(w.hash, SHINGLE)
    at = np.arange(len(hashes))
    inside = which[: len(hashes)] == which[SHINGLE - 1 :][: len(hashes)] if len(hashes) else np.zeros(0, bool)
    text, found = which[: len(hashes)][inside], hashes[at[inside]]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        own = np.array([ngram_hashes(w.hash[w.first[k] : w.first[k + 1]], int(n[k]))[0] for k in short], np.uint64)
        text, found = np.concatenate([text, short]), np.concatenate([found, own])
    return text, found


def weighted(text: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight), each shingle of a text once."""
    _, at, weight = np.unique(mixed(found + text.astype(np.uint64) * np.uint64(MUL)), return_index=True, return_counts=True)
    return text[at], found[at], weight


def bagminhash(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, m: int) -> np.ndarray:
    """Signatures (texts, m): in each component the identity of the earliest point. Texts without
    shingles have zeros."""
    total = np.bincount(text, weight, texts)
    first = np.full(texts * m, np.inf)
    name = np.zeros(texts * m, np.uint64)
    # one process for each interval (0, 1], (1, 2], (2, 4], ... that reaches below the weight
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1 if len(weight) else weight
    of = np.repeat(np.arange(len(weight)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    width = np.where(level == 0, 1, 1 << np.maximum(level - 1, 0))
    below = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    seed = mixed(shingle[of] * _C[0] + level.astype(np.uint64) * _C[1])
    room = weight[of] - below  # cells of the interval that the weight covers
    owner = text[of]
    until = (np.log(m) + 5) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        live = np.flatnonzero(todo[owner])
        time, key, turn = np.zeros(len(live)), seed[live], 0
        while len(live):
            turn += 1
            draw = mixed(key + np.uint64(turn * int(_C[2]) % (1 << 64)))
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * width[live])
            keep = time <= until[owner[live]]
            live, time, key, draw = live[keep], time[keep], key[keep], draw[keep]
            spot = mixed(draw + _C[3])
            slot = owner[live] * m + (spot % np.uint64(m)).astype(np.int64)
            ours = ((spot >> np.uint64(32)) % width[live].astype(np.uint64)).astype(np.int64) < room[live]
            slot, at, who = slot[ours], time[ours], draw[ours]
            np.minimum.at(first, slot, at)
            won = first[slot] == at
            name[slot[won]] = who[won]
        todo &= np.isinf(first.reshape(texts, m)).any(axis=1)
        until = np.where(todo, until * 2, until)
    return name.reshape(texts, m)


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, h, n, e1, e2, bands): shingles, digest of the multiset, band hashes."""
    m = BANDS * ROWS

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in in_parts(batch.column(2).to_pylist()):
                text, shingle, weight = weighted(*shingles(texts))
                n = np.bincount(text, weight, len(texts)).astype(np.int64)
                digest = np.zeros((2, len(texts)), np.uint64)
                for k in range(2):
                    np.add.at(digest[k], text, mixed(shingle * _C[k] + weight.astype(np.uint64) * _C[k + 2]))
                rows = bagminhash(text, shingle, weight, len(texts), m).reshape(len(texts), BANDS, ROWS)
                bands = np.zeros((len(texts), BANDS), np.uint64)
                for r in range(ROWS):
                    bands = mixed(bands * np.uint64(MUL) + rows[:, :, r])
                bands = mixed(bands + np.arange(BANDS, dtype=np.uint64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(bands.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), pa.array(n), *(pa.array(d.view(np.int64)) for d in digest), lists], ["doc_id", "h", "n", "e1", "e2", "bands"])

    return docs.mapInArrow(make, "doc_id long, h long, n long, e1 long, e2 long, bands array<long>")


def elements(docs: DataFrame) -> DataFrame:
    """(uid, n, set) for rows with uid and text: the multiset as a set, the j-th copy of a shingle being
    an element of its own."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in in_parts(batch.column(1).to_pylist()):
                text, shingle, weight = weighted(*shingles(texts))
                of = np.repeat(np.arange(len(weight)), weight)
                copy = np.arange(len(of)) - np.repeat(np.cumsum(weight) - weight, weight)
                owner, value = text[of], mixed(shingle[of] + copy.astype(np.uint64) * _C[1])
                order = np.argsort(owner, kind="stable")
                n = np.bincount(owner, minlength=len(texts))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(value[order].view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), lists], ["uid", "elements"])

    return docs.select("uid", "text").mapInArrow(make, "uid long, elements array<long>")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, ok): whether the pairs' multisets have at least the threshold's similarity; pairs whose sizes
    rule that out are left out."""
    left = pairs.join(sets.select(F.col("uid").alias("b"), F.col("elements").alias("y")), "b")
    both = left.join(sets.select(F.col("uid").alias("a"), F.col("elements").alias("x")), "a")
    common = F.size(F.array_intersect("x", "y"))
    # by size alone, the similarity is at most the smaller by the larger
    fits = F.least(F.size("x"), F.size("y")) >= threshold * F.greatest(F.size("x"), F.size("y"))
    return both.where(fits).select("a", "b", (common >= threshold * (F.size("x") + F.size("y") - common)).alias("ok"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, h (the text's hash), uid, copy (uid of the first of its
    copies), root (uid that names its near-duplicate class)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.col("text").alias("text"))
    made = written(features(own).withColumn("uid", F.monotonically_increasing_id()), "features")
    first = made.groupBy("e1", "e2", "n").agg(F.min("uid").alias("copy"))
    members = written(made.join(first, ["e1", "e2", "n"]).select("doc_id", "h", "uid", "copy", "n", F.when(F.col("uid") == F.col("copy"), F.col("bands")).alias("bands")), "members")

    spread = members.where("uid = copy and n > 0").select("uid", F.explode("bands").alias("bucket"))
    full = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    buckets = written(spread.join(full, "bucket"), "buckets")
    wanted = members.join(buckets.select("uid").distinct(), "uid", "left_semi").select("uid", "doc_id", "h")
    texts = own.where("text is not null").join(wanted, own["doc_id"].eqNullSafe(wanted["doc_id"]) & (own["h"] == wanted["h"])).select("uid", "text")
    sets = written(elements(texts).dropDuplicates(["uid"]), "sets")

    roots = link_buckets(buckets, lambda pairs: verified(pairs, sets, threshold), "docs", HUB_ROUNDS,
                         lambda rest: sets.join(rest, "uid").select("uid", "root", "elements"), threshold)
    found = members.join(roots.select(F.col("node").alias("copy"), "root"), "copy", "left")
    return found.select("doc_id", "h", "uid", "copy", F.coalesce("root", "copy").alias("root"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (the least doc_id of its near-duplicate class), copy_id
    (the least doc_id of its exact copies), class_size, kept (the first of its class)."""
    found = written(classes(docs, threshold), "doc-classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid")).alias("first")
    by_class = found.groupBy("root").agg(first, F.count(F.lit(1)).alias("class_size"))
    by_copy = found.groupBy("copy").agg(F.min("doc_id").alias("copy_id"))
    return found.join(by_class, "root").join(by_copy, "copy").select(
        "doc_id", "h", F.col("first.doc_id").alias("class_id"), "copy_id", "class_size", (F.col("uid") == F.col("first.uid")).alias("kept"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are the first of their class, with their columns as they are."""
    kept = near_duplicates(docs, threshold).where("kept").select(F.col("doc_id").alias("__d"), F.col("h").alias("__h"))
    named = [c for c in docs.columns]
    rows = docs.withColumn("__g", F.xxhash64("text"))
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(F.col("__d")) & (F.col("__g") == F.col("__h")), "left_semi")
    return rows.dropDuplicates(["doc_id", "__g"]).select(*named)


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("h")
