"""Phrase collocation mining (operator 13) by Rabin-Karp fingerprints.

Prefix polynomials (modulo 2**64, numpy) over the bytes give every word a hash, and prefix
polynomials over those give every run of words its fingerprint in two operations, whatever its
length. Four scans, none of which holds more than ``PENDING`` fingerprints or ``HELD`` phrases:

1. fingerprints of words, counted in the task and then by a shuffle of fingerprints and counts alone, sorted
   and by difference to the one before, a row for each of ``2**SLOT_BITS`` ranges of fingerprints;
2. the same for pairs of frequent words, since no phrase is more frequent than its parts;
3. the same for runs of three and four words all of whose pairs are frequent;
4. what reached the minimum is counted anew. In the task each occurrence is compared, word by word, with
   the first one of its fingerprint, and one row a phrase goes on with its text, its count and the
   pointer to a document; the shuffle groups by text. So two phrases of one fingerprint stay two, and
   only frequent phrases ever become text.

Between the scans goes a sieve of fixed size (``sieve.BITS`` bits, whatever the data) of the frequent
fingerprints. It only keeps rows out of the shuffles; the counts of the last scan decide. As the data
grow more rows pass it, which costs time and changes no result.

A phrase's parts are frequent too, so its cuts are scored by a join of frequent phrases to
themselves, salted for the single words that very many phrases share.

Defined cases: a null text is an empty one, a null language is ``und``; a null doc_id gives no
pointer; equal rows count each; a text without words counts nothing; very long texts are read whole, in
parts that end at a full stop or line feed where there is one; phrases of equal score and count are ordered by their bytes; an empty
table gives no row; other columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm.common import SQL, query, table, written
from cohortflow.llm.sieve import BITS, sieve
from cohortflow.llm.word_hashes import INV, MUL, SpanHasher, mixed, powers

LONGEST = 4
MINIMUM = 30
COVERED_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
NO_LANG = "und"
#: Bits of a fingerprint: fewer make smaller shuffles and let more rows pass the sieve, which has fewer still.
PRINT_BITS = 32
#: Bytes of text handled at once; fingerprints, and phrases of a block, held before they are passed on.
AT_ONCE, PENDING, HELD = 1 << 19, 1 << 20, 400_000
#: Rows of an Arrow batch taken out of it at once.
ROWS = 1000
#: Parts into which the rows of a shared single word, or of a language, are dealt.
SALTS = 8
#: Leading bits of a fingerprint that say to which group of the shuffle it goes.
SLOT_BITS = 11
#: Sorted fingerprints of a slot: the low 16 bits and the rest of their differences, the low 8 bits and the rest of
#: their counts. Apart, as the rest is nearly always zero and takes no room in a compressed shuffle.
PACKED = {"low": np.uint16, "high": np.uint16, "n": np.uint8, "more": np.uint32}
COUNTS = "slot int, " + ", ".join(f"{c} binary" for c in PACKED)
TEXTS = "phrase string, n long, first_doc long"
#: Between a phrase, which never holds it, and its language.
AFTER_PHRASE = "\n"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE, _CUT = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[32, 9]] = True
_CUT[[*b".,;:!?", *range(10, 14)]] = True


class RunHasher:
    """Fingerprints of runs of word hashes from one running sum."""

    def __init__(self, hashes: np.ndarray):
        n = max(1, len(hashes))
        self.down = powers(INV, n)
        self.total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * powers(MUL, n)[: len(hashes)], out=self.total[1:])

    def of(self, start: np.ndarray, size: int) -> np.ndarray:
        return (self.total[start + size] - self.total[start]) * self.down[start] + np.uint64(size)


class Block:
    """Words of some documents: where they are, which piece they stand in, their fingerprints by run length."""

    def __init__(self, texts: list[bytes], langs: list[str], hasher: SpanHasher, print_bits: int):
        self.mask = np.uint64((1 << print_bits) - 1)
        buf = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        self.raw = buf.tobytes()
        cut = _CUT[buf]
        gap = cut | _SPACE[buf]
        change = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        edges = change if gap[0] else np.concatenate([[0], change])
        self.buf, self.begin, self.end = buf, edges[0::2], edges[1::2]
        self.piece = np.cumsum(cut)[self.begin] if len(self.begin) else np.zeros(0, np.int64)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.concatenate([[0], np.searchsorted(self.begin, ends)])
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.words = hasher.hashes(buf, self.begin, self.end)
        names = sorted(set(langs))
        raw = np.frombuffer("\n".join(names).encode() + b"\n", np.uint8)
        stops = np.cumsum([len(x.encode()) + 1 for x in names])
        by_name = dict(zip(names, hasher.hashes(raw, np.concatenate([[0], stops[:-1]]), stops - 1), strict=True))
        self.lang = np.array([by_name[x] for x in langs], np.uint64)
        self.runs = RunHasher(self.words)
        self.spaced: np.ndarray | None = None

    def prints(self, size: int, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(first words, fingerprints) of runs of ``size`` words within a piece."""
        if start is None:
            n = len(self.begin) - size + 1
            if n <= 0:
                return np.zeros(0, np.int64), np.zeros(0, np.uint64)
            start = np.flatnonzero(self.piece[:n] == self.piece[size - 1 :])
        return start, mixed(self.runs.of(start, size) + self.lang[self.doc[start]] * np.uint64(MUL)) & self.mask

    def candidates(self, sizes: Iterable[int], bits: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, first words, fingerprints) of the runs whose parts pass the sieve: of a pair its words, of
        longer runs their pairs."""
        for size in sizes:
            if size > 1:
                parts = np.zeros(len(self.begin) + 1, bool)
                start, fp = self.prints(1 if size == 2 else 2)
                parts[start[passes(fp, bits)]] = True
            if size == 1:
                yield 1, *self.prints(1)
            elif size == 2:
                start, fp = self.prints(2)
                both = parts[start] & parts[start + 1]
                yield 2, start[both], fp[both]
            else:
                at = np.flatnonzero(parts)
                for k in range(1, size - 1):
                    at = at[parts[np.minimum(at + k, len(parts) - 1)]]
                yield size, *self.prints(size, at)

    def exact_words(self) -> np.ndarray:
        """A number for each word that equal words and no others share."""
        _, first, which = np.unique(self.words & self.mask, return_index=True, return_inverse=True)
        size, rep = (self.end - self.begin).astype(np.int32), first[which]
        same = size == size[rep]
        which = which.astype(np.int64)
        k = np.flatnonzero(same).astype(np.int32)
        n = size[k]
        step = np.arange(n.sum(), dtype=np.int32) - np.repeat(np.cumsum(n, dtype=np.int32) - n, n)
        unlike = self.buf[np.repeat(self.begin[k].astype(np.int32), n) + step] != self.buf[np.repeat(self.begin[rep[k]].astype(np.int32), n) + step]
        same[np.repeat(k, n)[unlike]] = False
        more: dict[bytes, int] = {}
        for w in np.flatnonzero(~same).tolist():  # words that share a hash with another one
            which[w] = len(first) + more.setdefault(self.raw[self.begin[w] : self.end[w]], len(more))
        return which

    def texts(self, start: np.ndarray, size: int) -> pa.StringArray:
        """The words from each place on, with single spaces between."""
        if self.spaced is None:
            n = (self.end - self.begin + 1).astype(np.int32)
            at = np.cumsum(n, dtype=np.int64) - n
            self.spaced = self.buf[np.repeat(self.begin - at, n) + np.arange(n.sum())]
            self.spaced[at + n - 1] = 32
            self.place = np.append(at, len(self.spaced))
        s = self.place[start]
        n = self.place[start + size] - 1 - s
        offsets = np.zeros(len(start) + 1, np.int32)
        np.cumsum(n, out=offsets[1:])
        data = self.spaced[np.repeat(s - offsets[:-1], n) + np.arange(offsets[-1])]
        return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data))


def passes(fp: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = fp & np.uint64(BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


_HASHER: list[SpanHasher] = []


def _parted(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about ``AT_ONCE`` bytes, cut at a full stop or line feed, where no phrase goes on."""
    at = 0
    while len(text) - at > AT_ONCE:
        cut = max(text.rfind(b".", at, at + AT_ONCE), text.rfind(b"\n", at, at + AT_ONCE))
        if cut < at:
            break
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


@dataclass
class Rows:
    """A block, and the doc_id and language of each of its texts."""

    block: Block
    ids: list[int | None]
    langs: list[str]


def _blocks(batch: pa.RecordBatch, print_bits: int) -> Iterator[Rows]:
    """The rows (doc_id, lang, text) of a batch in blocks, in ascending doc_id order, nulls last: the first
    occurrence in a block is one of the least doc_id."""
    if not _HASHER:
        _HASHER.append(SpanHasher())
    batch = batch.take(pc.sort_indices(batch.column(0)))
    ids: list[int | None] = []
    langs: list[str] = []
    texts: list[bytes] = []
    size = 0
    for at in range(0, batch.num_rows, ROWS):
        for doc, lang, text in zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns), strict=True):
            for part in _parted((text or "").encode()):
                ids.append(doc)
                langs.append(NO_LANG if lang is None else lang)
                texts.append(part)
                size += len(part)
                if size >= AT_ONCE:
                    yield Rows(Block(texts, langs, _HASHER[0], print_bits), ids, langs)
                    ids, langs, texts, size = [], [], [], 0
    if texts:
        yield Rows(Block(texts, langs, _HASHER[0], print_bits), ids, langs)


def _rest_bits(print_bits: int) -> int:
    """Bits of a fingerprint below its slot."""
    return min(max(print_bits - SLOT_BITS, 0), 32)


def _packed(fp: np.ndarray, n: np.ndarray, rest_bits: int) -> pa.RecordBatch:
    """Rows of ``COUNTS`` of sorted distinct fingerprints and their counts."""
    slot = fp >> np.uint64(rest_bits)
    at = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    step = np.diff(fp, prepend=fp[:1])
    step[at] = fp[at] & np.uint64((1 << rest_bits) - 1)
    parts = {"low": step & np.uint64(0xFFFF), "high": step >> np.uint64(16), "n": n & 0xFF, "more": n >> 8}
    edges = np.append(at, len(fp))
    columns = [pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((edges * np.dtype(t).itemsize).astype(np.int32)), pa.py_buffer(parts[c].astype(t))])
               for c, t in PACKED.items()]
    return pa.RecordBatch.from_arrays([pa.array(slot[at].astype(np.int32)), *columns], ["slot", *PACKED])


def _unpacked(rows: pa.Table, rest_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, counts) of rows of one slot, those of different rows side by side."""
    got = {c: [np.frombuffer(x, t) for x in rows.column(c).to_pylist()] for c, t in PACKED.items()}
    sizes = [len(x) for x in got["low"]]
    flat = {c: np.concatenate(x).astype(np.uint64) for c, x in got.items()}
    total = np.cumsum(flat["low"] | (flat["high"] << np.uint64(16)))
    before = np.concatenate([np.zeros(1, np.uint64), total])[np.cumsum([0, *sizes[:-1]])]
    fp = total - np.repeat(before, sizes) + (np.uint64(rows.column("slot")[0].as_py()) << np.uint64(rest_bits))
    return fp, (flat["n"] | (flat["more"] << np.uint64(8))).astype(np.int64)


def _counted(docs: DataFrame, print_bits: int, runs_of: Callable[[Block], Iterator[np.ndarray]]) -> DataFrame:
    """Frequent fingerprints of the runs that ``runs_of(block)`` gives."""
    rest_bits = _rest_bits(print_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            return _packed(*np.unique(np.concatenate(some), return_counts=True), rest_bits)

        for batch in batches:
            for rows in _blocks(batch, print_bits):
                for fp in runs_of(rows.block):
                    some.append(fp)
                    size += len(fp)
                if size >= PENDING:
                    yield out()
                    some, size = [], 0
        if size:
            yield out()

    def often(rows: pa.Table) -> pa.Table:
        fp, n = _unpacked(rows, rest_bits)
        fp, which = np.unique(fp, return_inverse=True)
        total = np.zeros(len(fp), np.int64)
        np.add.at(total, which, n)
        return pa.table({"fp": fp[total >= MINIMUM].view(np.int64)})

    return docs.mapInArrow(run, COUNTS).groupBy("slot").applyInArrow(often, "fp long")


def _bits(frequent: DataFrame) -> np.ndarray:
    """The sieve of fingerprints as bytes: ``BITS`` / 8 of them, of any data."""
    out = np.zeros(BITS // 8, np.uint8)
    for row in sieve(frequent, F.col("fp")).collect():  # at most BITS / 2**15 rows of 4 KB
        part = np.frombuffer(row["sieve_bits"], np.uint8)
        out[row["sieve_row"] * len(part) :][: len(part)] = part
    return out


def _found(rows: Rows, bits: np.ndarray) -> list[pa.Table]:
    """Tables of ``TEXTS``, one for each run length, and one of the numbers of words (no phrase)."""
    block, langs = rows.block, pa.array([AFTER_PHRASE + x for x in rows.langs], pa.string())
    ids = pa.array(rows.ids, pa.int64())
    names = ["phrase", "n", "first_doc"]
    out = [pa.table([langs, pa.array(np.diff(block.first).astype(np.int64)), ids], names=names)]
    exact = block.exact_words()
    for size, start, fp in block.candidates(range(1, LONGEST + 1), bits):
        some = passes(fp, bits)
        start, fp = start[some], fp[some]
        _, at, which, n = np.unique(fp, return_index=True, return_inverse=True, return_counts=True)
        alike = block.lang[block.doc[start]] == block.lang[block.doc[start[at]]][which]
        for j in range(size):
            alike &= exact[start + j] == exact[start[at] + j][which]
        others = np.flatnonzero(~alike)  # occurrences whose text isn't the one that the fingerprint points to
        places = np.concatenate([at, others])
        counts = np.concatenate([n - np.bincount(which[others], minlength=len(n)), np.ones(len(others), np.int64)]).astype(np.int64)
        word = start[places]
        doc = pa.array(block.doc[word])
        out.append(pa.table([pc.binary_join_element_wise(block.texts(word, size), langs.take(doc), ""), pa.array(counts), ids.take(doc)], names=names))
    return out


def _merged(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
    """Equal phrases as one row each, sorted: neighbours with a common beginning make the shuffle smaller."""
    sums = pa.TableGroupBy(pa.concat_tables(tables), "phrase", use_threads=False).aggregate([("n", "sum"), ("first_doc", "min")])
    yield from sums.select(["phrase", "n_sum", "first_doc_min"]).rename_columns(["phrase", "n", "first_doc"]).sort_by("phrase").combine_chunks().to_batches()


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", print_bits: int = PRINT_BITS) -> DataFrame:
    """(lang, phrase, size, n, first_doc) of all phrases of up to four words that occur ``MINIMUM`` times in
    their language or more, and of each language a row of size 0 with its number of words. Written below
    the shared folder. Fewer ``print_bits`` let more fingerprints collide; no result depends on them."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def and_these(known: np.ndarray, sizes: tuple[int, ...]) -> np.ndarray:
        """The sieve with the frequent fingerprints of these run lengths as well."""
        sent = spark.sparkContext.broadcast(known)
        return known | _bits(_counted(own, print_bits, lambda b: (fp for _, _, fp in b.candidates(sizes, sent.value))))

    bits = and_these(np.zeros(BITS // 8, np.uint8), (1,))
    bits = and_these(bits, (2,))
    every = spark.sparkContext.broadcast(and_these(bits, tuple(range(3, LONGEST + 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = every.value
        for batch in batches:
            some: list[pa.Table] = []
            size = 0
            for rows in _blocks(batch, print_bits):
                some += _found(rows, bits)
                size += sum(len(t) for t in some[-LONGEST - 1 :])
                if size >= HELD:
                    yield from _merged(some)
                    some, size = [], 0
            if some:
                yield from _merged(some)

    sums = own.mapInArrow(run, TEXTS).groupBy("phrase").agg(F.sum("n").alias("n"), F.min("first_doc").alias("first_doc"))
    both = F.split("phrase", AFTER_PHRASE, 2)
    found = sums.select(both[1].alias("lang"), both[0].alias("phrase"), "n", "first_doc").withColumn("size", F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))))
    return written(found.where((F.col("n") >= MINIMUM) | (F.col("size") == 0)), "phrases")


def _salt(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")


def collocations(frequent: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, first_doc): the best ``top`` phrases of each language."""
    phrases = frequent.where(F.col("size") > 0)
    found = phrases.where(F.col("size") > 1).select("lang", "phrase", "size", F.col("n").alias("a"), "first_doc", F.split("phrase", " ").alias("w"))

    cuts = found.select("lang", "phrase", "a", "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    parts = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.slice("w", F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit(1).alias("side"), F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")).alias("part")))).alias("x"))
    parts = parts.select("lang", "phrase", "a", "k", "x.side", F.array_join("x.part", " ").alias("part"),
                         F.when(F.size("x.part") == 1, _salt(F.col("phrase"))).otherwise(0).alias("salt"))
    salts = F.when(F.col("size") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    counts = phrases.where(F.col("size") < LONGEST).select("lang", F.col("phrase").alias("part"), "n", F.explode(salts).alias("salt"))
    sides = parts.join(counts, ["lang", "part", "salt"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("n"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("n"))).alias("r"))
    score = F.expr(f"(CAST(a AS DECIMAL(20, 0)) * {SCALE}) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    scored = sides.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    within = found.where(F.col("size") > 2).select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = (found.join(within, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < COVERED_PERCENT * F.col("a")))
            .join(scored, ["lang", "phrase"]).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "first_doc"))

    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    first = kept.withColumn("salt", _salt(F.col("phrase"))).withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    words = frequent.where(F.col("size") == 0).select("lang", "n")
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc")


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(frequent_phrases(table(spark, sf_dir, "documents"))).drop("first_doc")


SQL["op13_phrase_collocations"] = f"""
WITH docs AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM docs),
words AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
runs AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE len(w) >= size)),
f AS (SELECT lang, phrase, size, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= {MINIMUM}),
found AS (SELECT lang, phrase, size, a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (SELECT lang, phrase, size, a, w, unnest(generate_series(1, size - 1)) AS k FROM found),
sides AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, ({SCALE}::HUGEINT * c.a) // (x.a + y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
scored AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_runs AS (
  SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, m, unnest(generate_series(1, size - m + 1)) AS i FROM found, (VALUES (2), (3)) AS sizes(m) WHERE size > m)),
within AS (SELECT lang, phrase, max(a) AS longer FROM inner_runs GROUP BY ALL),
kept AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score::BIGINT AS score
  FROM scored s LEFT JOIN within USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {COVERED_PERCENT} * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN words USING (lang) WHERE rank <= {TOP}
"""
