"""Conversation structure repair (operator 11) by a Viterbi search whose survivors coalesce.

``repair`` finds, for each conversation, the cheapest edits that leave the role initials
``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert (a user's or
assistant's empty text, anywhere) 3, and a truncated row that stays 3 more; blank and repeated rows
must go. Of equally cheap edits the ASCII-least string of initials counts.

The rows of a conversation pass once, in order, through the four states of that pattern (nothing
yet, after s, after u, after a). Each state keeps its best path as a leaf of a tree of back pointers
with reference counts. Equal costs are decided by the complete strings from the oldest unresolved
edit on: two paths to one state that have read as many rows at equal cost are never prefixes of one
another, since a further insertion costs more, so whatever follows leaves their order as it is. A
state that can't win any more is dropped: "after a" can do what "after s" can, and all that "nothing
yet" can but for one kept system row, which it deletes for 4. When a single path leaves the tree's
root, all survivors share its edits, and they are written out. What is held is the rows since the
last common edit: a handful, unless a long run of rows leaves two beginnings equally open.

Faults and order come from Spark: rows are dealt by conversation once, a window numbers the equal
(role, text) of a conversation in that same dealing, and the sort spills. A conversation is
streamed, never held, however long it is; it isn't cut up, since the digest of its repaired text can
only be taken in order.

Defined cases: null roles and texts are one space, null turns sort first, and rows of equal turn are
ordered by role and text; a null conv_id is a conversation of its own; equal rows are repeats; a
conversation without rows after the damage has zeros, an empty audit and the digest of the empty
string; very long texts are rows like others; an empty table gives no row; other columns of any name
are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from cohortflow.llm.common import query, table

WHITE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a. From which states a role's initial leads where.
EMPTY, AFTER_S, AFTER_U, AFTER_A = range(4)
STEPS = {"s": {EMPTY: AFTER_S}, "u": {EMPTY: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
#: A state's next role where one is made up, and the state it leads to.
MADE_UP = {EMPTY: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A), AFTER_A: ("user", AFTER_U)}
LEGAL = {"su", "ua", "au"}
AT_ONCE = 2000


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy, dropped): the rows after the damage, dropped ones marked."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    way = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    role, text = F.when(way == 4, "user").otherwise(shown("role")), shown("text")
    text = F.when(way == 1, "").when(way == 2, F.translate(text, STOPS, "")).otherwise(text)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (way == 0).alias("dropped"),
                       F.explode(F.when(way == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation and sorted in each, with the first ``fault`` of each that isn't dropped."""
    told = F.rtrim(F.col("text"), F.lit(WHITE))
    same = F.unhex(F.sha2(F.concat(F.octet_length("role"), F.lit(":"), "role", "text"), 256))
    order = [F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    seen = F.row_number().over(Window.partitionBy("conv_id", "dropped", "same").orderBy(F.col("turn").asc_nulls_first(), "copy")) > 1
    fault = F.when(told == "", "blank").when(seen, "duplicate").when(~F.right(told, F.lit(1)).isin(*STOPS), "truncated")
    return (rows.withColumn("same", same).repartition("conv_id").withColumn("fault", fault)
            .sortWithinPartitions("conv_id", *order).select("conv_id", "turn", "role", "text", "fault", "dropped"))


class _Node:
    """An edit on a path: its parent, initial, role given, and how many nodes or survivors point here."""

    __slots__ = ("parent", "edit", "refs", "role")

    def __init__(self, parent: _Node | None, edit: str, role: str | None):
        self.parent, self.edit, self.role, self.refs = parent, edit, role, 0
        if parent is not None:
            parent.refs += 1


class Survivors:
    """The best path to each state for the rows of one conversation so far."""

    def __init__(self) -> None:
        self.root = _Node(None, "", None)
        self.best: dict[int, tuple[int, _Node]] = {EMPTY: (0, self.root)}
        self.root.refs = 1

    def _string(self, node: _Node) -> str:
        letters = []
        while node is not self.root:
            letters.append(node.edit)
            node = node.parent
        return "".join(reversed(letters))

    def _offer(self, to: dict, state: int, cost: int, parent: _Node, edit: str, role: str | None) -> bool:
        had = to.get(state)
        if had is not None:
            if cost > had[0]:
                return False
            if cost == had[0] and self._string(parent) + edit >= self._string(had[1]):
                return False
        node = _Node(parent, edit, role)
        node.refs += 1
        to[state] = (cost, node)
        if had is not None:
            self._release(had[1])
        return True

    def _release(self, node: _Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node is not self.root:
            node = node.parent
            node.refs -= 1

    def _insert(self) -> None:
        """Insertions before the next row, or at the end."""
        work = list(self.best)
        while work:
            state = work.pop()
            cost, node = self.best[state]
            role, after = MADE_UP[state]
            if self._offer(self.best, after, cost + INSERT, node, "I", role):
                work.append(after)

    def read(self, role: str, fault: str | None) -> None:
        """The edits of one more row."""
        self._insert()
        after: dict[int, tuple[int, _Node]] = {}
        stays = fault not in ("blank", "duplicate")
        more = TRUNCATED if fault == "truncated" else 0
        kept = STEPS.get(role[:1], {})
        for state, (cost, node) in self.best.items():
            self._offer(after, state, cost + DELETE, node, "D", None)
            if stays:
                if state in kept:
                    self._offer(after, kept[state], cost + KEEP + more, node, "K", role)
                given, to = MADE_UP[state]
                self._offer(after, to, cost + REROLE + more, node, "R", given)
        if AFTER_A in after:
            bound = after[AFTER_A][0]
            for state, slack in ((AFTER_S, 0), (EMPTY, DELETE)):
                if state in after and after[state][0] > bound + slack:
                    self._release(after.pop(state)[1])
        for _, node in self.best.values():
            self._release(node)
        self.best = after

    def settled(self) -> Iterator[tuple[str, str | None]]:
        """(edit, role) that all survivors share, the oldest first; they leave the tree."""
        if self.root.refs != 1:
            return
        leaves = {id(n) for _, n in self.best.values()}
        path = []
        node = next(iter(self.best.values()))[1]
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            if self.root.refs != 1 or id(self.root) in leaves:
                return
            yield node.edit, node.role
            node.parent = None
            self.root = node

    def end(self) -> Iterator[tuple[str, str | None]]:
        """The edits left when the last row was read."""
        self._insert()
        ends = [(c, self._string(n), s) for s, (c, n) in self.best.items() if s in (EMPTY, AFTER_A)]
        node = self.best[min(ends)[2]][1]
        path = []
        while node is not self.root:
            path.append((node.edit, node.role))
            node = node.parent
        yield from reversed(path)


def _edits(rows: Iterator[dict]) -> Iterator[tuple]:
    """(conv_id, turn, edit, old_role, role, text, fault) in order; each conversation begins with a
    row that has its conv_id only."""
    now: tuple | None = None
    paths, held = Survivors(), deque()

    def out(edits: Iterator[tuple[str, str | None]]) -> Iterator[tuple]:
        for edit, role in edits:
            if edit == "I":
                yield (now[0], None, "I", None, role, "", None)
            else:
                r = held.popleft()
                yield (now[0], r["turn"], edit, r["role"], role, r["text"], r["fault"])

    for r in rows:
        if now is None or r["conv_id"] != now[0]:
            if now is not None:
                yield from out(paths.end())
            now = (r["conv_id"],)
            paths, held = Survivors(), deque()
            yield (now[0], None, None, None, None, None, None)
        if not r["dropped"]:
            held.append(r)
            paths.read(r["role"], r["fault"])
            yield from out(paths.settled())
    if now is not None:
        yield from out(paths.end())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield from batch.slice(at, AT_ONCE).to_pylist()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    size = 0
    for r in rows:
        some.append(r)
        size += len(r[5] or "") if len(r) == 7 else len(r[7])
        if len(some) >= AT_ONCE or size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)


def _arrow(kind: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def repair(rows: DataFrame) -> DataFrame:
    """The edits of each conversation in order, from rows (conv_id, turn, role, text, copy, dropped):
    (conv_id, turn, edit, old_role, role, text, fault). Rows with edit K, R or I are the repaired
    conversation; a row without edit stands before each conversation's first. The rows of a
    conversation are in one partition, in order."""
    kind = rows.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", _arrow(kind)), ("turn", pa.int64()), *[(c, pa.string()) for c in ("edit", "old_role", "role", "text", "fault")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_edits(_rows(batches)), schema)

    return _in_order(rows).mapInArrow(run, f"conv_id {kind.simpleString()}, turn long, edit string, old_role string, role string, text string, fault string")


class _Summary:
    def __init__(self, conv_id: object):
        self.conv_id = conv_id
        self.turns, self.low, self.turn, self.before = 0, None, None, None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.sha, self.first = hashlib.sha256(), True

    def add(self, r: dict) -> None:
        edit = r["edit"]
        self.audit.append(edit)
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            if r["turn"] is not None and r["turn"] != self.turn:
                self.low = r["turn"] if self.low is None else self.low
                self.turn, self.turns = r["turn"], self.turns + 1
            initial = r["old_role"][:1]
            self.illegal += self.before is not None and self.before + initial not in LEGAL
            self.before = initial
            if r["fault"]:
                self.faults[r["fault"]] += 1
            self.cost += TRUNCATED if r["fault"] == "truncated" and edit != "D" else 0
        if edit != "D":
            self.sha.update((("" if self.first else "\n") + r["role"] + ":" + r["text"]).encode())
            self.first = False

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def summaries(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s result, in its partitions: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    kind = edits.schema["conv_id"].dataType
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv_id", _arrow(kind)), *[(c, pa.int64()) for c in longs], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def fold(rows: Iterator[dict]) -> Iterator[tuple]:
        one = None
        for r in rows:
            if r["edit"] is None:
                if one is not None:
                    yield one.row()
                one = _Summary(r["conv_id"])
            else:
                one.add(r)
        if one is not None:
            yield one.row()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(fold(_rows(batches)), schema)

    return edits.mapInArrow(run, f"conv_id {kind.simpleString()}, {', '.join(f'{c} long' for c in longs)}, audit string, repaired_sha256 string")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries(repair(damaged(table(spark, sf_dir, "conversations"))))
