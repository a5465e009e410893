"""Secret scans by one deterministic automaton for all rules (operator 2).

Every rule has a probe, a short expression that each of its matches contains; the probes of all
rules are compiled together (subset construction, minimisation, transition arrays over byte
classes), and one pass over the bytes of a batch finds where any accepts. Only lines with such a
place are looked at again: each rule's own anchored automaton finds its leftmost longest matches
there, without overlaps, and the rule's length condition drops the failing ones. No rule's match
holds a line feed, so lines are independent.

Spans are kind:start:end in code points, end exclusive. Defined cases: a null or empty text has no
spans; a null doc_id stays null; equal rows get equal results; an empty table gives no row; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.automaton import Dfa, accepted_at, compile_rules, longest_from
from cohortflow.llm.common import query, table

_KEY = rb"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"


def _value_of(match: bytes) -> bytes:
    """Group 2: what follows the sign, without spaces and an opening quote. The name before holds
    neither : nor =."""
    after = match[min(x for x in (match.find(b":"), match.find(b"=")) if x >= 0) + 1 :].lstrip(b" ")
    return after[1:] if after[:1] in (b'"', b"'") else after


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: bytes
    probe: bytes
    ok: Callable[[bytes], bool]


#: The base kinds, in the order in which spans of equal start are listed; then those of our own.
BASE = (
    Rule("assign", _KEY + rb"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", _KEY + rb"""["']?\x20*[:=]""", lambda m: len(_value_of(m)) >= 6),
    Rule("access", rb"AKIA[A-Z0-9]+", rb"AKIA[A-Z0-9]", lambda m: len(m) >= 20),
    Rule("hex", rb"[0-9a-f]+", rb"[0-9a-f]{24}", lambda m: len(m) >= 24),
)
MORE = (
    Rule("pem", rb"-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-----", rb"-----BEGIN ", lambda m: True),
    Rule("github", rb"gh[pousr]_[A-Za-z0-9]+", rb"gh[pousr]_", lambda m: len(m) >= 40),
    Rule("google", rb"AIza[A-Za-z0-9_-]+", rb"AIza", lambda m: len(m) >= 39),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]+", rb"xox[abprs]-", lambda m: len(m) >= 15),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", rb"\.eyJ", lambda m: len(m) >= 40),
    Rule("url_login", rb"[a-z]+://[A-Za-z0-9_.-]+:[A-Za-z0-9_.!$%-]+@", rb"://", lambda m: True),
)


class Scanner:
    """The compiled rules. ``spans`` gives each text's spans as (kind, start, end)."""

    def __init__(self, rules: tuple[Rule, ...] = BASE + MORE):
        self.rules = rules
        self.probe = compile_rules([r.probe for r in rules], anywhere=True)
        self.single: list[tuple[Rule, Dfa, list[int], list[int], bytes]] = []
        for r in rules:
            d = compile_rules([r.pattern], anywhere=False)
            begins = bytes(b for b in range(256) if d.next[d.begin * d.classes + d.class_of[b]] != d.dead)
            self.single.append((r, d, d.next.tolist(), d.class_of.tolist(), begins))

    def spans(self, texts: list[str | None], at_once: int = 1 << 22) -> Iterator[list[tuple[str, int, int]]]:
        some: list[bytes] = []
        size = 0
        for text in texts:
            some.append((text or "").encode())
            size += len(some[-1])
            if size >= at_once:
                yield from self._spans(some)
                some, size = [], 0
        yield from self._spans(some)

    def _spans(self, docs: list[bytes]) -> Iterator[list[tuple[str, int, int]]]:
        if not docs:
            return
        data = np.frombuffer(b"\n".join(docs) + b"\n", np.uint8)
        hits = accepted_at(self.probe, data)
        begins = np.cumsum([0, *(len(d) + 1 for d in docs)])
        of = np.searchsorted(begins, hits, "right") - 1
        by_doc: dict[int, list[int]] = {}
        for k, at in zip(of.tolist(), (hits - begins[of]).tolist(), strict=True):
            by_doc.setdefault(k, []).append(at)
        for k, doc in enumerate(docs):
            yield self._of_doc(doc, by_doc[k]) if k in by_doc else []

    def _of_doc(self, doc: bytes, hits: list[int]) -> list[tuple[str, int, int]]:
        found, done = [], -1
        for at in hits:
            if at < done:
                continue
            begin = doc.rfind(b"\n", 0, at + 1) + 1
            done = doc.find(b"\n", at)
            done = len(doc) if done < 0 else done
            line, before = doc[begin:done], None
            for order, (rule, dfa, go, class_of, first) in enumerate(self.single):
                k, n = 0, len(line)
                while k < n:
                    if line[k] in first and (end := longest_from(dfa, go, class_of, line, k)) > k:
                        if rule.ok(line[k:end]):
                            if before is None:
                                before = len(doc[:begin].decode())
                            a = before + len(line[:k].decode())
                            found.append((a, order, rule.kind, a + len(line[k:end].decode())))
                        k = end
                    else:
                        k += 1
        return [(kind, a, b) for a, _, kind, b in sorted(found)]


_SCANNER: list[Scanner] = []


def scanner() -> Scanner:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    return _SCANNER[0]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (kind, begin, end)."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "begin": a, "end": b} for k, a, b in s] for s in scanner().spans(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, span)], ["doc_id", "spans"])

    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,begin:bigint,end:bigint>>")


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def text(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])))

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
