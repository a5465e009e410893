"""Substring dedup by suffix automata of reference shards (operator 10).

Every window of ``WINDOW`` consecutive words that also starts in a document with a smaller doc_id is
removed. The reference of a document is thus the corpus before it, whose automata can't be
broadcast: their size grows with the data, and every document would have to be streamed through all
of them. So the reference is cut into shards by content, and documents are sent only to the shards
that can match:

1. Fingerprints. Of the ``WINDOW - GRAM + 1`` word n-grams in each window, the one with the least
   hash is the window's anchor. Equal windows have equal anchors.
2. An anchor that only one document holds can't be part of a match. Counts, least and greatest
   doc_id by anchor (map-side sums first) tell which ones are shared.
3. Runs of windows with one shared anchor become segments: their words, as text. Which anchors are
   shared is looked up in a bitmap of fixed size (``BITMAP`` bits, 16 MB broadcast) while there are
   few enough of them for it; where there are more, each document gets the list of its own by a
   join. The bitmap may let unshared anchors pass, whose segments then meet no other.
   A segment goes to the shard of its anchor. Where an anchor has more than ``SHARD`` occurrences, its windows are dealt
   one by one over as many shards as that takes, by a hash of the window; equal windows still meet.
   A window that very many documents hold is one key all the same, so rows of such anchors are
   dealt by a hash of the document as well, in two steps: each part finds the rows that a smaller
   doc_id of its own covers, and what it leaves, one row of each window at most, meets in the
   window's shard.
4. Each shard streams its segments in the order of doc_id: matching statistics against the suffix
   automaton of all segments of smaller doc_ids give the maximal spans of at least ``WINDOW`` words
   that it holds; then the segment joins the automaton, if it isn't in it already.
5. The spans go back to their documents, and their words are left out.

Hashes only route: what is removed is decided by comparing words.

Defined cases: a null or empty text has no words; a null doc_id is no reference and loses nothing;
rows of equal doc_id are one document to each other, so neither is a reference for the other, and
stay rows of their own; equal rows get equal results; an empty table gives no row; other columns of
any name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import SQL, query, table, written
from cohortflow.llm.sieve import parted, sieve
from cohortflow.llm.word_hashes import Words, in_parts, ngram_hashes, words_of

WINDOW = 13
GRAM = 5
SHARD = 4_000
#: Bits of the bitmap; it is used for at most an eighth as many shared anchors, and with at most so many
#: anchors that have more than one shard (12 bytes each).
BITMAP = 1 << 27
MANY_SHARDS = 1 << 20


class SuffixAutomaton:
    """Of several word sequences: it accepts each sequence's substrings, and none across two."""

    def __init__(self) -> None:
        self.go: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]

    def add(self, words: list) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _split(self, p: int, q: int, w) -> int:
        copy = len(self.go)
        self.go.append(dict(self.go[q]))
        self.link.append(self.link[q])
        self.size.append(self.size[p] + 1)
        while p >= 0 and self.go[p].get(w) == q:
            self.go[p][w] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, w) -> int:
        if w in self.go[last]:  # a sequence before begins alike
            q = self.go[last][w]
            return q if self.size[q] == self.size[last] + 1 else self._split(last, q, w)
        new = len(self.go)
        self.go.append({})
        self.link.append(0)
        self.size.append(self.size[last] + 1)
        p = last
        while p >= 0 and w not in self.go[p]:
            self.go[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.go[p][w]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, w)
        return new

    def matches(self, words: list) -> Iterator[int]:
        """The matching statistics: for each word, the length of the longest substring ending there."""
        at = length = 0
        go, link, size = self.go, self.link, self.size
        for w in words:
            while at and w not in go[at]:
                at = link[at]
                length = size[at]
            if w in go[at]:
                at = go[at][w]
                length += 1
            yield length


def matched_spans(lengths: Iterator[int], window: int) -> list[tuple[int, int]]:
    """Maximal spans of words in matches of at least ``window`` words."""
    out: list[tuple[int, int]] = []
    for i, n in enumerate(lengths):
        if n >= window:
            if out and i + 1 - window <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((i + 1 - window, i + 1))
    return out


def anchors(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of each text: its first word, its anchor's place, and the anchor."""
    grams = ngram_hashes(w.hash, GRAM)
    wide = WINDOW - GRAM + 1
    if len(w.hash) < WINDOW:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    begins = np.arange(len(w.hash) - WINDOW + 1)
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    begins = begins[text[begins] == text[begins + WINDOW - 1]]
    place = begins + np.lib.stride_tricks.sliding_window_view(grams, wide).argmin(axis=1)[begins]
    return begins, place, grams[place]


def held_anchors(docs: DataFrame) -> DataFrame:
    """(a, doc_id, h) for each place of a document that is the anchor of a window."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, h = (batch.column(k).to_numpy() for k in (0, 1))
            for first, texts in in_parts(batch.column(2).to_pylist()):
                w = words_of(texts)
                _, place, _ = anchors(w)
                if not len(place):
                    continue
                place = np.unique(place)
                row = first + np.searchsorted(w.first, place, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(ngram_hashes(w.hash, GRAM)[place].view(np.int64)), pa.array(ids[row]), pa.array(h[row])], ["a", "doc_id", "h"])

    return docs.mapInArrow(emit, "a long, doc_id long, h long")


def shared_anchors(docs: DataFrame) -> DataFrame:
    """(a, deal): anchors that several doc_ids hold, with the number of shards that their windows are
    dealt over."""
    seen = held_anchors(docs).groupBy("a").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"))
    return seen.where("low < high").select("a", F.ceil(F.col("n") / SHARD).cast("int").alias("deal"))


def bitmap_of(shared: DataFrame) -> bytes:
    """BITMAP bits, one set for each shared anchor modulo BITMAP."""
    row = 1 << 15  # bits that bitmap_construct_agg holds
    bit = F.pmod(F.col("a"), F.lit(BITMAP))
    parts = shared.select((bit / row).cast("int").alias("r"), (bit % row).alias("bit")).groupBy("r").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = bytearray(BITMAP // 8)
    for p in parts:
        out[p["r"] * row // 8 : (p["r"] + 1) * row // 8] = p["bits"]
    return bytes(out)


SEGMENT = "a long, deal int, part int, doc_id long, h long, first int, words binary"
_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]


def _segments_of(w: Words, ids: list, hs: list, begins: np.ndarray, place: np.ndarray, anchor: np.ndarray, deal: np.ndarray) -> Iterator[tuple]:
    """Rows of SEGMENT for the windows given, of the texts with these ids."""
    if not len(begins):
        return
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (begins[1:] != begins[:-1] + 1)]))
    last = np.concatenate([new[1:], [len(begins)]]) - 1
    text = np.searchsorted(w.first, begins[new], "right") - 1
    raw, at, end = w.raw, w.begin, w.end
    for x, y, k, a, n in zip(begins[new].tolist(), begins[last].tolist(), text.tolist(), anchor[new].view(np.int64).tolist(), deal[new].tolist(), strict=True):
        base, stop = int(w.first[k]), y + WINDOW
        if n == 1:
            yield a, 0, -1, ids[k], hs[k], x - base, b" ".join(raw[at[x] : end[stop - 1]].split())
            continue
        for z, hashed in zip(range(x, y + 1), ngram_hashes(w.hash[x:stop], WINDOW).tolist(), strict=True):
            yield a, hashed % n, ids[k] * 0x9E3779B1 % (1 << 32) % n, ids[k], hs[k], z - base, b" ".join(raw[at[z] : end[z + WINDOW - 1]].split())


def _batches(rows: Iterator[tuple], at_once: int = 20_000) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, at_once)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), _KINDS, strict=True)], [x.split()[0] for x in SEGMENT.split(", ")])


def segments(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """(a, deal, part, doc_id, h, first, words): runs of windows with one shared anchor; part is -1 where
    the anchor has one shard."""
    spread = shared.where("deal > 1").limit(MANY_SHARDS + 1).collect() if shared.count() <= BITMAP // 8 else None
    if spread is None or len(spread) > MANY_SHARDS:
        return _segments_by_lists(docs, shared)
    spread = sorted((r["a"], r["deal"]) for r in spread)
    many = np.array([a for a, _ in spread], np.int64).view(np.uint64), np.array([d for _, d in spread], np.int64)
    order = np.argsort(many[0])
    known = docs.sparkSession.sparkContext.broadcast((bitmap_of(shared), many[0][order], many[1][order]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot, deals = known.value
        bits = np.frombuffer(bits, np.uint8)
        for batch in batches:
            ids, hs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, texts in in_parts(batch.column(2).to_pylist()):
                w = words_of(texts)
                begins, place, anchor = anchors(w)
                bit = (anchor.view(np.int64) % BITMAP).astype(np.int64)
                yes = np.flatnonzero((bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                anchor, deal = anchor[yes], np.ones(len(yes), np.int64)
                if len(hot):
                    j = np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)
                    deal = np.where(hot[j] == anchor, deals[j], 1)
                yield from _batches(_segments_of(w, ids[first:], hs[first:], begins[yes], place[yes], anchor, deal))

    return docs.select("doc_id", "h", "text").mapInArrow(cut, SEGMENT)


def _segments_by_lists(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """The same by a join: each document with the list of its shared anchors."""
    lists = held_anchors(docs).join(shared, "a").groupBy("doc_id", "h").agg(F.collect_set(F.struct("a", "deal")).alias("shared"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs, own = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for k, text in enumerate(batch.column(2).to_pylist()):
                w = words_of([text.encode()])
                begins, place, anchor = anchors(w)
                a = own[k].values.field(0).to_numpy().view(np.uint64)
                order = np.argsort(a)
                a, deals = a[order], own[k].values.field(1).to_numpy()[order]
                j = np.minimum(np.searchsorted(a, anchor), len(a) - 1)
                yes = np.flatnonzero(a[j] == anchor)
                yield from _batches(_segments_of(w, [ids[k]], [hs[k]], begins[yes], place[yes], anchor[yes], deals[j[yes]]))

    return docs.join(lists, ["doc_id", "h"]).select("doc_id", "h", "text", "shared").mapInArrow(cut, SEGMENT)


class Shard:
    """Segments of one shard in the order of doc_id."""

    def __init__(self) -> None:
        self.known: set[bytes] = set()
        self.waiting: list[bytes] = []
        self.automaton: SuffixAutomaton | None = None
        self.doc, self.own = None, set()

    def spans(self, doc_id: int, words: bytes) -> list[tuple[int, int]]:
        """The segment's spans that smaller doc_ids hold."""
        if doc_id != self.doc:
            new = self.own - self.known
            self.known |= new
            self.waiting += sorted(new)
            self.doc, self.own = doc_id, set()
        self.own.add(words)
        if not self.known:
            return []
        if words in self.known:  # all of it is one of the automaton's sequences
            return [(0, words.count(b" ") + 1)]
        if self.automaton is None:
            self.automaton = SuffixAutomaton()
        for w in self.waiting:
            self.automaton.add(w.split(b" "))
        self.waiting = []
        return matched_spans(self.automaton.matches(words.split(b" ")), WINDOW)


SPAN = "a long, deal int, doc_id long, h long, begin int, end int, words binary"
_SPAN_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]


def _streamed(cut: DataFrame, by: list[str]) -> DataFrame:
    """SPAN rows of each shard's segments, dealt by ``by`` and streamed in the order of doc_id. Where a
    segment has a part that isn't -1 and nothing covers it, it is passed on with its words."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard = None, Shard()
        for batch in batches:
            out: list[tuple] = []
            for a, deal, part, doc_id, h, first, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, deal, part) != key:
                    key, shard = (a, deal, part), Shard()
                found = shard.spans(doc_id, words)
                out += [(a, deal, doc_id, h, first + x, first + y, None) for x, y in found]
                if part >= 0 and not found:
                    out.append((a, deal, doc_id, h, first, first + WINDOW, words))
            cols = list(zip(*out, strict=True)) or [[]] * len(_SPAN_KINDS)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _SPAN_KINDS, strict=True)], [x.split()[0] for x in SPAN.split(", ")])

    columns = [x.split()[0] for x in SEGMENT.split(", ")]
    return cut.select(*columns).repartition(*by).sortWithinPartitions(*by, "doc_id").mapInArrow(stream, SPAN)


def removals(cut: DataFrame) -> DataFrame:
    """(doc_id, h, begin, end): spans of words to remove."""
    first = written(_streamed(cut, ["a", "deal", "part"]), "spans")
    left = first.where("words is not null").select("a", "deal", F.lit(-1).alias("part"), "doc_id", "h", F.col("begin").alias("first"), "words")
    more = _streamed(left, ["a", "deal", "part"])
    columns = ["doc_id", "h", "begin", "end"]
    return first.where("words is null").select(*columns).union(more.select(*columns))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, text (the kept words joined by one space)."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    known = own.where("doc_id is not null and text is not null")
    shared = written(shared_anchors(known), "shared-anchors")
    spans = removals(segments(known, shared))
    spans = written(spans.distinct().groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans")), "removals")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                kept, at = [], 0
                for s in cuts or []:
                    kept += words[at : max(at, s["begin"])]
                    at = max(at, s["end"])
                kept += words[at:]
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
            cols = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["doc_id", "n_words", "n_removed", "text"])

    # documents that lose nothing stay out of the shuffle
    key = F.xxhash64("doc_id", "h")
    some, none = parted(own, key, sieve(spans, key))
    both = some.join(spans, ["doc_id", "h"], "left").select("doc_id", "text", "spans").union(
        none.select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")))
    return both.mapInArrow(keep, "doc_id long, n_words long, n_removed long, text string")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL["op10_substring_dedup"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT rid, doc_id, b, list_slice(w, b, b + {WINDOW - 1}) AS g
        FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - {WINDOW - 1} + 1)) AS b FROM d WHERE doc_id IS NOT NULL)),
first AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT rid, list(DISTINCT p) AS ps
         FROM (SELECT rid, unnest(range(b, b + {WINDOW})) AS p FROM win JOIN first USING (g) WHERE m < doc_id) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (rid)"""
