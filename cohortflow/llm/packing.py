"""Best-fit packing (operator 9): documents into as few sequences of at most ``capacity`` tokens.

``pack`` encodes each document, adds the end id, cuts only what is longer than the capacity, and
places the pieces. Pieces of one length are alike, so the instance is its histogram: at most
``capacity`` counts, however many documents there are. That histogram is all that comes to the
driver. ``solve`` first applies Martello and Toth's dominance reduction to it: with the longest
remaining length w and what it leaves free, a set of one, two or three pieces that dominates every
other way to fill its sequence is fixed for good, for as many sequences as the counts allow at once;
what the reduction can't fix is packed best-fit in decreasing length, over groups of sequences that
have the same free space. The plan says which ranks of each length go where (its size depends on the
capacity alone), and every piece finds its place from its rank among the pieces of its length: the
prefix sum of the counts of earlier partitions plus its place in its own.

Defined cases: a null text is an empty one (the end id alone); rows of equal doc_id, equal rows and
rows with a null doc_id are packed each for itself; an empty table gives no row; other columns of
any name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm.common import query, table, written
from cohortflow.llm.tokens import encoder, vocab_path

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length int, ids binary, part int, place int"


@dataclass
class Group:
    """``count`` sequences that hold the same lengths: ``items`` of (length, how many)."""

    count: int
    free: int
    items: list[tuple[int, int]] = field(default_factory=list)


class Lengths:
    """Counts by length, with the largest present length not above a bound and the smallest."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n = [0] * (capacity + 1)
        for w, c in counts.items():
            self.n[w] = c

    def largest(self, bound: int) -> int:
        w = min(bound, len(self.n) - 1)
        while w > 0 and not self.n[w]:
            w -= 1
        return max(w, 0)

    def smallest(self, k: int) -> list[int]:
        """The k smallest pieces (fewer if there are fewer)."""
        out: list[int] = []
        for w, c in enumerate(self.n):
            out += [w] * min(c, k - len(out))
            if len(out) == k:
                break
        return out


def reduce_dominated(left: Lengths, capacity: int) -> list[Group]:
    """Martello and Toth's reduction: fix sets that dominate, longest length first.

    Let w be a length, r = capacity - w, and k the most pieces that fit beside it.
    k = 0: {w} alone. Let b be the longest piece with b <= r. b = r: {w, b} fills the sequence and
    dominates. k = 1: {w, b} dominates, as no set holds more than one further piece and none a longer
    one. k = 2: {w, b} dominates {w, x, y} whenever x + y <= b for all fitting pairs (x, y); else,
    a pair (x, y) dominates if it is the only fitting one: both the two smallest pieces, with the
    next smallest not fitting beside the smaller one, and b <= the longer of them.
    Lengths where none of this holds are left for best fit."""
    fixed: list[Group] = []
    w = left.largest(capacity)
    while w:
        while left.n[w]:
            r = capacity - w
            left.n[w] -= 1  # beside w itself
            small, b = left.smallest(4), left.largest(r)
            k = 0
            total = 0
            for x in small[:3]:
                total += x
                if total > r:
                    break
                k += 1
            left.n[w] += 1
            if k == 0:
                fixed.append(Group(left.n[w], r, [(w, 1)]))
                left.n[w] = 0
            elif b == r or k == 1 or (k == 2 and _best_pair(left, w, r) <= b):
                # holds for every further one too: the pieces only get fewer, and b stays while it lasts
                each = left.n[w] // 2 if b == w else min(left.n[w], left.n[b])
                fixed.append(Group(each, r - b, [(w, 2)] if b == w else [(w, 1), (b, 1)]))
                left.n[w] -= each
                left.n[b] -= each
            elif k == 2 and len(small) >= 2 and b <= small[1] and (len(small) < 3 or small[0] + small[2] > r):
                x, y = small[:2]
                need: dict[int, int] = {}
                for v in (w, x, y):
                    need[v] = need.get(v, 0) + 1
                fixed.append(Group(1, r - x - y, list(need.items())))
                for v, c in need.items():
                    left.n[v] -= c
            else:
                break
        w = left.largest(w - 1)
    return fixed


def _best_pair(left: Lengths, w: int, r: int) -> int:
    """The largest x + y <= r over two pieces beside one of length w (0 if there is none)."""
    left.n[w] -= 1
    best, x, y = 0, 1, left.largest(r)
    while x <= y:
        if not left.n[x]:
            x += 1
        elif x + y > r or not left.n[y] or (x == y and left.n[x] < 2):
            y = left.largest(y - 1)
        else:
            best = max(best, x + y)
            x += 1
    left.n[w] += 1
    return best


def best_fit(left: Lengths, capacity: int) -> list[Group]:
    """Best fit in decreasing length over groups of equal sequences."""
    by_free: list[list[Group]] = [[] for _ in range(capacity + 1)]
    closed: list[Group] = []
    w = left.largest(capacity)
    while w:
        c = left.n[w]
        left.n[w] = 0
        free = w
        while c and free <= capacity:
            while c and by_free[free]:
                g = by_free[free].pop()
                m = min(free // w, c)  # the same piece again is what best fit would place next
                full = min(g.count, c // m)
                if full < g.count:
                    by_free[free].append(Group(g.count - full, free, g.items))
                c -= full * m
                new = Group(full, free - m * w, [*g.items, (w, m)])
                (by_free[new.free] if new.free else closed).append(new)
            free += 1
        m = capacity // w
        if c // m:
            g = Group(c // m, capacity - m * w, [(w, m)])
            (by_free[g.free] if g.free else closed).append(g)
        if c % m:
            by_free[capacity - c % m * w].append(Group(1, capacity - c % m * w, [(w, c % m)]))
        w = left.largest(w - 1)
    return closed + [g for gs in by_free for g in gs]


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Groups of sequences that hold every counted piece once."""
    if any(w < 1 or w > capacity for w in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    left = Lengths(counts, capacity)
    fixed = reduce_dominated(left, capacity)
    return fixed + best_fit(left, capacity)


def places(groups: list[Group], capacity: int) -> np.ndarray:
    """Rows (length, first rank, ranks, pieces a sequence, first sequence, offset), by length and
    rank: rank q of the length goes to sequence first + (q - first rank) // pieces, at offset +
    (q - first rank) % pieces * length."""
    next_rank = [0] * (capacity + 1)
    rows, sequence = [], 0
    for g in groups:
        offset = 0
        for w, m in g.items:
            rows.append((w, next_rank[w], g.count * m, m, sequence, offset))
            next_rank[w] += g.count * m
            offset += w * m
        sequence += g.count
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pieces(docs: DataFrame, vocab: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), part and
    place (the partition that made it, and its rank there among the pieces of its length)."""
    vocab = vocab or vocab_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seen = encoder(vocab), TaskContext.get().partitionId(), [0] * (capacity + 1)
        names = ["doc_id", "piece", "start", "length", "ids", "part", "place"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()]
        for batch in batches:
            rows: list[tuple] = []
            for key, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1).to_pylist()), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    own = ids[at : at + capacity]
                    rows.append((key, k, at, len(own), own.tobytes(), part, seen[len(own)]))
                    seen[len(own)] += 1
                if len(rows) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, vocab: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Every piece and its place: doc_id, piece, start, length, ids (little-endian unsigned 32-bit;
    not with ``with_ids`` false, where only ids_crc32 is carried along), ids_crc32, sequence_id, offset."""
    carried = ["doc_id", "piece", "start", "length", *["ids"] * with_ids, "ids_crc32"]
    made = written(pieces(docs, vocab, capacity, end_id, id_col, text_col), "pieces").withColumn("ids_crc32", F.crc32("ids"))
    by_part = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # a length has at most one row a partition here
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = written(by_part.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "piece-counts")
    histogram = before.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    plan = places(solve({r["length"]: r["n"] for r in histogram}, capacity), capacity)
    row_of = np.searchsorted(plan[:, 0], np.arange(capacity + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            w, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            sequence, offset = np.empty(len(w), np.int64), np.empty(len(w), np.int64)
            for v in np.unique(w):
                own = np.flatnonzero(w == v)
                a, b = row_of[v], row_of[v + 1]
                r = plan[a + np.searchsorted(plan[a:b, 1], rank[own], "right") - 1]
                q = rank[own] - r[:, 1]
                sequence[own], offset[own] = r[:, 4] + q // r[:, 3], r[:, 5] + q % r[:, 3] * v
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array(sequence), pa.array(offset)], [*carried, "sequence_id", "offset"])

    # the counts grow with the partitions, so they aren't to be broadcast
    ranked = made.join(before.select("length", "part", "before").hint("merge"), ["length", "part"]).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), *["ids"] * with_ids, "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))
    schema = f"doc_id long, piece int, start long, length long, {'ids binary, ' * with_ids}ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
