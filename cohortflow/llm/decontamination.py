"""Benchmark decontamination by a prefix-filtered set join (operator 3, DataFrame operations only).

A document is contaminated by an item's window of 13 words (all of an item that has fewer) where it
holds the window's words in their order. As sets, the document must hold every shingle of the
window, so one necessary shingle is enough to look for: containment of all n leaves a prefix of
n - n + 1 = 1. The shingles here are the window's words, ordered by rarity over the whole corpus, and
the rarest one, with its place in the window, is the prefix. The join meets each word of a document
that is the prefix of some window; the place bounds where the window would begin and its length
where it would end; what is left is verified exactly, word for word, in the row that carries the
document's words, so nothing but the hits leaves the scan.

Both the rarity count and the join read the documents' words against the benchmark, which is
broadcast if it is small (``BROADCAST_BYTES`` as measured on its own rows), and else joined by
shuffling words, which then takes a join back to the documents' words.

Defined cases: null texts have no words, so neither hits nor windows; rows of equal doc_id and text
each get the result of that text, and rows of equal doc_id and other text their own; items of one
text all count; null item_ids aren't listed; an empty benchmark hits nothing; an empty documents
table gives no row; other columns of any name are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm.common import SQL, query, table, written

WINDOW = 13
BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, before and after A-Z are lower-cased.
GAP_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else. Plain lower() does that where all of the text is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The words; a gap at either end leaves an empty string, which is taken off. Null: none."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), GAP_ANY), "")


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """Distinct (win, n): the words of every window, and their number."""
    w = items.select(words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    begins = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return w.select("w", F.explode(begins).alias("b")).select(F.slice("w", F.col("b"), size).alias("win")).distinct()


def hits(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document text and occurrence: doc_id, h (the text's hash), begin, n, win."""
    wins = written(windows_of(items, size), "windows")
    vocabulary = wins.select(F.explode("win").alias("word")).distinct()
    measured = wins.agg(F.coalesce(F.sum(F.length(F.array_join("win", " ")) * 4 + 200), F.lit(0)).alias("b")).first()["b"]
    small = measured <= BROADCAST_BYTES

    own = docs.select("doc_id", F.xxhash64("text").alias("h"), words_of(F.col("text")).alias("words"))
    # the whole corpus counts the benchmark's words; map-side sums leave one row a word and task
    each = own.select(F.explode("words").alias("word"))
    seen = each.join(F.broadcast(vocabulary) if small else vocabulary, "word").groupBy("word").agg(F.count(F.lit(1)).alias("seen"))
    counts = written(vocabulary.join(seen, "word", "left").select("word", F.coalesce("seen", F.lit(0)).alias("seen")), "word-counts")

    spots = wins.select("win", F.posexplode("win").alias("place", "word")).join(counts, "word")
    rarest = F.row_number().over(Window.partitionBy("win").orderBy("seen", "word", "place"))
    prefix = spots.withColumn("r", rarest).where("r = 1").select("word", "place", "win", F.size("win").alias("n"))
    prefix = written(prefix, "prefixes")

    places = own.select("doc_id", "h", *["words"] * small, F.size("words").alias("n_words"), F.posexplode("words").alias("pos", "word"))
    begin = F.col("pos") - F.col("place")
    fits = (begin >= 0) & (begin + F.col("n") <= F.col("n_words"))
    if small:
        same = F.slice("words", begin + 1, F.col("n")) == F.col("win")
        near = places.join(F.broadcast(prefix), "word").where(fits & same)
    else:
        near = places.join(prefix, "word").where(fits).select("doc_id", "h", begin.alias("begin"), "n", "win").distinct()
        same = F.slice("words", F.col("begin") + 1, F.col("n")) == F.col("win")
        return near.join(own.distinct(), near["doc_id"].eqNullSafe(own["doc_id"]) & (near["h"] == own["h"])).where(same).select(
            near["doc_id"], near["h"], "begin", "n", "win")
    return near.select("doc_id", "h", begin.alias("begin"), "n", "win")


def measure(docs: DataFrame, items: DataFrame, size: int = WINDOW, share: int = 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (sorted item ids as text), and
    contaminated (``share`` * n_hit >= n_words)."""
    docs = docs.select("doc_id", "text")
    items = items.select("item_id", "text").where("text is not null")
    found = written(hits(docs, items, size), "hits")

    # words hit: an occurrence adds what lies beyond the end of all before it
    order = Window.partitionBy("doc_id", "h").orderBy("begin", "end")
    spans = found.select("doc_id", "h", "begin", (F.col("begin") + F.col("n")).alias("end")).distinct()
    reach = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = spans.select("doc_id", "h", F.greatest(F.col("end") - F.greatest("begin", reach), F.lit(0)).alias("more"))
    covered = covered.groupBy("doc_id", "h").agg(F.sum("more").cast("long").alias("n_hit"))

    w = items.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    begins = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    of_item = w.select("item_id", "w", F.explode(begins).alias("b")).select("item_id", F.slice("w", F.col("b"), size).alias("win")).distinct()
    named = found.select("doc_id", "h", "win").distinct().join(of_item, "win").select("doc_id", "h", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list("item")).alias("items"))

    both = covered.join(named, covered["doc_id"].eqNullSafe(named["doc_id"]) & (covered["h"] == named["h"]), "left").select(
        covered["doc_id"].alias("d"), covered["h"].alias("g"), "n_hit", "items")
    # the count of words needs no lower-casing, and no array
    every = docs.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce(F.size(F.array_remove(F.split("text", GAP_ANY), "")), F.lit(0)).cast("long").alias("n_words"))
    out = every.join(both, every["doc_id"].eqNullSafe(both["d"]) & (every["h"] == both["g"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      "h", ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def remove_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, share: int = 20) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with their columns as they are."""
    bad = measure(docs, items, size, share).where("contaminated").select(F.col("doc_id").alias("__d"), F.col("h").alias("__h")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("__d")) & (F.xxhash64(docs["text"]) == F.col("__h")), "left_anti")


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measure(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_SQL_WORDS = rf"list_filter(string_split_regex(translate(text, '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
SQL["op3_decontamination"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_SQL_WORDS} AS w FROM documents),
item_windows AS (
  SELECT DISTINCT item_id, list_slice(w, b, b + {WINDOW - 1}) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS b
        FROM (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM item_windows),
doc_windows AS (
  SELECT rid, n, b, list_slice(w, b, b + n - 1) AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS b FROM d JOIN sizes ON len(w) >= n)),
found AS (SELECT DISTINCT rid, n, b, win FROM doc_windows WHERE win IN (SELECT win FROM item_windows)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(b, b + n)) AS p FROM found) GROUP BY rid),
named AS (SELECT rid, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM found JOIN item_windows USING (win) GROUP BY rid)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)"""
