"""Personal data by weak supervision (operator 8, DataFrame operations only).

Candidates are the matches of one expression per kind. Splitting a text at the expression gives what
stands between the matches, so the lengths of both give every match's place. The base kinds keep the
matches that pass their check, always. Four labelers vote on every candidate (for, against or
neither): the strict form, gazetteers (top-level domains, calling codes, card issuers, country codes,
given names), the words around, and the edges. Votes are counted by kind and pattern over the whole
corpus; expectation-maximisation over those counts (as many rows as there are patterns, 810 at most)
estimates how reliable each labeler is and how likely each pattern is personal data; these
probabilities train the final span classifier, a logistic regression over votes, kind and length, which is
applied as a column expression. It adds spans of the further kinds that it holds to be personal
with probability ``ADD_FROM`` or more, for which two labelers at least vote and none votes against,
and which overlap no base span.

Defined cases: a null or empty text has no spans; rows of equal doc_id and text get equal results,
rows of equal doc_id and other text their own; a null doc_id stays null; an empty table gives no
row; other columns of any name are not read. A match of any length is found without recursion
(possessive repeats) and in linear time (matches begin where a run begins, or the last one ended).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm.common import query, table, written

AROUND = 40
ADD_FROM = 0.9
BASE_KINDS = ("email", "ip", "card", "phone")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    s = _digits(m)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(s, F.length(s) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), add)
    return F.when(F.length(s).between(13, 19), total % 10 == 0).otherwise(F.lit(False))


def _byte_parts(m: Column) -> Column:
    return ~m.rlike(r"(^|\.)0*([1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(\.|$)")


@dataclass(frozen=True)
class Kind:
    """gate: a quick condition that every text with a match meets. check: the strict form.
    gazetteer: a vote's condition for, or None. near: words around that speak for the kind."""

    name: str
    pattern: str
    gate: Callable[[Column], Column]
    check: Callable[[Column], Column]
    gazetteer: Callable[[Column], Column]
    near: str


# Top-level domains, calling codes, issuer prefixes, countries with IBANs, given names.
TLDS = "com|org|net|edu|gov|io|co|info|de|fr|es|it|uk|us|eu|nl|ch|at|jp|cn|in|br|ru|au|ca"
CALLING = "1|7|20|27|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[12368]|35[0-9]|37[0-8]|38[0-9]|42[013]|85[2356]|88[06]|97[0-9]|99[2-8]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38"
IBAN = "AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|RO|SE|SK"
NAMES = "James|John|Robert|Michael|William|David|Mary|Patricia|Jennifer|Linda|Elizabeth|Susan|Anna|Maria|Peter|Thomas|Laura|Sarah|Jean|Pierre|Marie|Hans|Klaus|Carlos|Jose|Ana"

KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: F.contains(t, F.lit("@")), lambda m: F.lit(True), lambda m: m.rlike(rf"\.({TLDS})$"), "mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda t: t.rlike(r"[0-9]\.[0-9]"), _byte_parts, lambda m: m.rlike(r"^(10|127|172|192)\."), r"\bip\b|host|server|login|address"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++",
         lambda t: t.rlike("[0-9][ -]?[0-9]"), _luhn, lambda m: _digits(m).rlike(f"^({ISSUERS})"), "card|visa|credit|pay"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]",
         lambda t: F.contains(t, F.lit("+")), lambda m: F.length(_digits(m)).between(9, 15), lambda m: _digits(m).rlike(f"^({CALLING})"), "phone|tel|call|fax|mobile"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda t: t.rlike("[0-9]{3}-[0-9]{2}-"), lambda m: ~m.rlike("^(000|666|9)|-00-|-0000$"), lambda m: F.lit(False), r"\bssn\b|social security"),
    Kind("iban", r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Z0-9])",
         lambda t: t.rlike("[A-Z]{2}[0-9]{2}[A-Z0-9]{11}"), lambda m: m.rlike("[0-9]{6}"), lambda m: m.rlike(f"^({IBAN})"), "iban|bank|account|konto"),
    Kind("mac", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}(?![0-9A-Fa-f:])",
         lambda t: t.rlike("[0-9A-Fa-f]{2}:[0-9A-Fa-f]{2}:"), lambda m: ~m.rlike("^(00:){5}00$"), lambda m: F.lit(False), r"\bmac\b|device|ethernet"),
    Kind("email_spelt", r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z]{2,24}){1,4}",
         lambda t: t.rlike(r"[(\[]at[)\]]"), lambda m: F.lit(True), lambda m: m.rlike(rf"[ .)\]]({TLDS})$"), "mail|contact|write"),
    Kind("phone_local", r"(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
         lambda t: t.rlike("[0-9]{3}[ .-][0-9]{4}"), lambda m: ~_digits(m).rlike("^[01]|^...[01]"), lambda m: F.lit(False), "phone|tel|call|fax|mobile"),
    Kind("name", r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr)\.? [A-Z][a-z]{1,30} [A-Z][a-z]{1,30}(?![A-Za-z])",
         lambda t: t.rlike(r"\b(Mr|Mrs|Ms|Dr)\b"), lambda m: F.lit(True), lambda m: m.rlike(rf" ({NAMES}) "), "dear|sincerely|patient|contact"),
)
AGAINST = r"version|isbn|order no|invoice|article|part no"
LABELERS = ("form", "gazetteer", "context", "edges")


def candidates(docs: DataFrame) -> DataFrame:
    """One row per match: doc_id, h (the text's hash), kind, begin, end, ok (the strict form), the four
    votes, and size (a class of length).

    Texts that pass a gate are written first; then each kind reads them with an expression of its
    own, which keeps the generated code small."""
    t = F.col("text")
    gates = KINDS[0].gate(t)
    for k in KINDS[1:]:
        gates = gates | k.gate(t)
    gated = written(docs.where("text is not null").where(gates).select("doc_id", F.xxhash64("text").alias("h"), "text"), "gated")

    def matches(k: Kind) -> DataFrame:
        between, found = F.split(t, k.pattern, -1), F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))
        cut = gated.where(k.gate(t)).select("doc_id", "h", between.alias("p"), found.alias("m")).where(F.size("m") > 0)
        rows = cut.select("doc_id", "h", F.posexplode(F.arrays_zip("p", "m", F.slice("p", 2, F.size("p")).alias("q"))).alias("k", "x")).where("x.m is not null")
        m, left, right = F.col("x.m"), F.right("x.p", F.lit(AROUND)), F.left("x.q", F.lit(AROUND))
        rows = rows.select("doc_id", "h", "k", F.length("x.p").alias("gap"), m.alias("m"), F.lower(F.concat_ws(" ", left, right)).alias("around"),
                           (F.right("x.p", F.lit(1)).rlike("[A-Za-z0-9]") | F.left("x.q", F.lit(1)).rlike("[A-Za-z0-9]")).alias("touches"))
        m, around = F.col("m"), F.col("around")
        return rows.select("doc_id", "h", F.lit(k.name).alias("kind"), "k", "gap", F.length("m").alias("long"), k.check(m).alias("ok"),
                           F.when(k.gazetteer(m), 1).otherwise(0).alias("gazetteer"),
                           F.when(around.rlike(AGAINST), -1).when(around.rlike(k.near), 1).otherwise(0).alias("context"),
                           F.when(F.col("touches"), -1).otherwise(1).alias("edges"))

    each = matches(KINDS[0])
    for k in KINDS[1:]:
        each = each.union(matches(k))
    each = written(each.distinct(), "candidates")  # equal rows are one here
    before = Window.partitionBy("doc_id", "h", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("long")).over(before)
    return each.withColumn("end", end).select(
        "doc_id", "h", "kind", (F.col("end") - F.col("long")).alias("begin"), "end", "ok",
        F.when(F.col("ok"), 1).otherwise(-1).alias("form"), "gazetteer", "context", "edges",
        F.when(F.col("long") < 10, 0).when(F.col("long") < 18, 1).otherwise(2).alias("size"))


def reliabilities(patterns: list[tuple[str, tuple[int, ...], float]], rounds: int = 100) -> dict[tuple[str, tuple[int, ...]], float]:
    """Expectation-maximisation over counted vote patterns (kind, votes, count): the probability that a
    candidate with this pattern is personal. Each labeler has, for either truth, its chances of the
    three votes; each kind its share of true candidates."""
    post = {(k, v): 1 / (1 + math.exp(-sum(v))) for k, v, _ in patterns}
    for _ in range(rounds):
        votes = [{(y, x): 1.0 + (x == (1 if y else -1)) for y in (0, 1) for x in (-1, 0, 1)} for _ in LABELERS]
        share: dict[str, list[float]] = {}
        for k, v, n in patterns:
            p = post[k, v]
            s = share.setdefault(k, [1.0, 1.0])
            s[0] += n * (1 - p)
            s[1] += n * p
            for j, x in enumerate(v):
                votes[j][0, x] += n * (1 - p)
                votes[j][1, x] += n * p
        total = [[sum(t[y, x] for x in (-1, 0, 1)) for y in (0, 1)] for t in votes]
        new = {}
        for k, v, _ in patterns:
            odds = math.log(share[k][1] / share[k][0])
            for j, x in enumerate(v):
                odds += math.log(votes[j][1, x] / total[j][1]) - math.log(votes[j][0, x] / total[j][0])
            new[k, v] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        moved = max((abs(new[x] - post[x]) for x in post), default=0.0)
        post = new
        if moved < 1e-6:
            break
    return post


def features(kind: str, votes: tuple[int, ...], size: int) -> list[str]:
    return ["bias", f"kind={kind}", f"size={size}", *[f"{n}={x}" for n, x in zip(LABELERS, votes, strict=True)]]


def train(rows: list[tuple[str, tuple[int, ...], int, float, float]], rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> dict[str, float]:
    """Logistic regression over counted rows (kind, votes, size, count, probability)."""
    weight: dict[str, float] = {}
    every = sum(r[3] for r in rows) or 1.0
    for _ in range(rounds):
        grad: dict[str, float] = {}
        for kind, votes, size, n, p in rows:
            f = features(kind, votes, size)
            z = max(-50.0, min(50.0, sum(weight.get(x, 0.0) for x in f)))
            e = n / every * (1 / (1 + math.exp(-z)) - p)
            for x in f:
                grad[x] = grad.get(x, 0.0) + e
        for x, g in grad.items():
            weight[x] = weight.get(x, 0.0) * (1 - rate * decay) - rate * 4 * g
    return weight


def probability(weight: dict[str, float]) -> Column:
    """The classifier as a column expression."""
    z = F.lit(weight.get("bias", 0.0))
    for x, w in sorted(weight.items()):
        if x != "bias":
            name, value = x.split("=")
            z = z + F.when(F.col(name).cast("string") == value, F.lit(w)).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base and added: arrays of (order of the kind, begin, end, kind)."""
    docs = docs.select("doc_id", "text")
    found = written(candidates(docs), "votes")
    grid = found.groupBy("kind", *LABELERS, "size").agg(F.count(F.lit(1)).alias("n")).collect()  # kinds x 3^4 x 3 rows at most
    counted: dict[tuple[str, tuple[int, ...]], float] = {}
    for r in grid:
        key = (r["kind"], tuple(r[x] for x in LABELERS))
        counted[key] = counted.get(key, 0.0) + r["n"]
    post = reliabilities([(k, v, n) for (k, v), n in sorted(counted.items())])
    weight = train([(r["kind"], v, r["size"], r["n"], post[r["kind"], v]) for r in sorted(grid, key=str) for v in [tuple(r[x] for x in LABELERS)]])

    order = F.array_position(F.array(*[F.lit(k.name) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct(order.alias("order"), "begin", "end", "kind")
    base = F.col("kind").isin(*BASE_KINDS) & F.col("ok")
    votes_for = sum((F.when(F.col(x) == 1, 1).otherwise(0) for x in LABELERS), F.lit(0))
    against = F.least(*[F.col(x) for x in LABELERS]) < 0
    added = ~F.col("kind").isin(*BASE_KINDS) & (votes_for >= 2) & ~against & (probability(weight) >= ADD_FROM)
    by_doc = found.where(base | added).groupBy("doc_id", "h").agg(
        F.array_sort(F.collect_list(F.when(base, span))).alias("base"), F.array_sort(F.collect_list(F.when(added, span))).alias("more"))
    free = F.filter("more", lambda e: ~F.exists("base", lambda b: (e["begin"] < b["end"]) & (b["begin"] < e["end"])))
    by_doc = by_doc.select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "base", free.alias("added"))
    every = docs.select("doc_id", F.xxhash64("text").alias("h"))
    return every.join(by_doc, every["doc_id"].eqNullSafe(by_doc["d"]) & (every["h"] == by_doc["g"]), "left").select("doc_id", "base", "added")


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))

    def text(spans: Column) -> Column:
        return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ","), F.lit(""))

    def count(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("base", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")

    every = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(every).alias("spans"))
