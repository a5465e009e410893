"""Parts of the operators on their own, against plain versions."""

import random
import re

import brute
import numpy as np
import pytest

from cohortflow.llm import components as components_module
from cohortflow.llm import license_scan, packing, personal_data, substrings, tokens, word_hashes
from cohortflow.llm.automaton import accepted_at, compile_rules, longest_from
from cohortflow.llm.components import components, link_buckets
from cohortflow.llm.minhash_docs import bagminhash
from cohortflow.llm.sieve import parted, sieve


@pytest.mark.parametrize("pattern", [b"ab+c", b"(ab|cd)*e", b"[a-c]{2,4}d?", b"a.c", b"[^ab]x{3}"])
def test_automaton_finds_what_the_expression_finds(pattern):
    rng = random.Random(pattern)
    probe, one = compile_rules([pattern], anywhere=True), compile_rules([pattern], anywhere=False)
    go, classes = one.next.tolist(), one.class_of.tolist()
    for _ in range(60):
        data = bytes(rng.choice(b"abcdex \n") for _ in range(rng.randint(0, 90)))
        ends = {k for k in range(len(data)) if any(re.compile(b"(?:" + pattern + b")").fullmatch(data, a, k + 1) for a in range(k + 1))}
        for lane in (1, 7, 1024):
            assert set(accepted_at(probe, np.frombuffer(data, np.uint8), lane).tolist()) == ends
        for a in range(len(data)):
            longest = max((k for k in range(a + 1, len(data) + 1) if re.compile(pattern).fullmatch(data, a, k)), default=-1)
            assert longest_from(one, go, classes, data, a) in (longest, -1 if longest < 0 else longest)


def test_automaton_is_minimal():
    assert len(compile_rules([b"ab|ac|ad"], anywhere=False).rules) == len(compile_rules([b"a[b-d]"], anywhere=False).rules) == 4


def test_suffix_automaton_matching_statistics():
    rng = random.Random(3)
    for _ in range(60):
        known = [[rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(rng.randint(1, 5))]
        text = [rng.choice("abcd") for _ in range(20)]
        sam = substrings.SuffixAutomaton()
        for k in known:
            sam.add(k)
        parts = {tuple(k[a:b]) for k in known for a in range(len(k)) for b in range(a + 1, len(k) + 1)}
        want = [max((n for n in range(i + 2) if n == 0 or tuple(text[i + 1 - n : i + 1]) in parts)) for i in range(len(text))]
        assert list(sam.matches(text)) == want
    assert substrings.matched_spans(iter([1, 2, 3, 3, 0, 0, 0, 3, 0]), 3) == [(0, 4), (5, 8)]


def test_words_and_hashes():
    texts = ["", " a  b\tc\n", "é à", "x" * 5000, "a b c"]
    w = word_hashes.words_of([t.encode() for t in texts])
    assert [w.raw[a:b].decode() for a, b in zip(w.begin, w.end, strict=True)] == [x for t in texts for x in brute.words(t)]
    assert np.diff(w.first).tolist() == [len(brute.words(t)) for t in texts]
    by = {}
    for a, b, h in zip(w.begin, w.end, w.hash.tolist(), strict=True):
        assert by.setdefault(w.raw[a:b], h) == h
    assert len(set(by.values())) == len(by)


def test_pieces_encode_like_whole_texts():
    texts = ["", None, "a.b,c ..d .5 x!!. <|endoftext|> <|ENDOFTEXT|> it's IT'S.", "É. é. ẖ H̱. a b\tc\x1cd\x85e ΣΑΣ", "\n\n", " . , ", "x" * 3000, "ab, c. " * 900]
    want = [a[:-1].tolist() for a in brute.whole_ids(texts, 0)]
    for at_once, capacity in ((1 << 20, 1000), (500, 1000), (500, 5)):
        enc = tokens.PieceEncoder(tokens.vocab_path(), capacity)
        assert [x.tolist() for x in enc.encode(texts, at_once)] == want


def test_packing_holds_every_piece_and_is_near_the_bound():
    rng = random.Random(4)
    for _ in range(30):
        capacity = rng.choice([10, 50, 200])
        counts = {w: rng.randint(1, 40) for w in rng.sample(range(1, capacity + 1), rng.randint(1, min(capacity, 30)))}
        groups = packing.solve(dict(counts), capacity)
        held: dict[int, int] = {}
        for g in groups:
            assert sum(w * m for w, m in g.items) + g.free == capacity
            for w, m in g.items:
                held[w] = held.get(w, 0) + m * g.count
        assert held == counts
        # the exact bound of pieces over half the capacity, and of the sum
        bound = max(-(-sum(w * c for w, c in counts.items()) // capacity), sum(c for w, c in counts.items() if 2 * w > capacity))
        assert sum(g.count for g in groups) <= bound * 11 // 9 + 1
        plan = packing.places(groups, capacity)
        assert plan[:, 2].sum() == sum(counts.values())
    assert sum(g.count for g in packing.solve({6: 3, 4: 3}, 10)) == 3
    with pytest.raises(ValueError):
        packing.solve({11: 1}, 10)


def test_patience_alignment():
    rng = random.Random(6)
    for _ in range(100):
        places = [rng.randint(0, 15) for _ in range(rng.randint(0, 12))]
        kept = [places[k] for k in license_scan.increasing(places)]
        assert all(a < b for a, b in zip(kept, kept[1:], strict=False))
        chosen = ([p for k, p in enumerate(places) if m >> k & 1] for m in range(1 << len(places)))
        best = max(len(c) for c in chosen if all(x < y for x, y in zip(c, c[1:], strict=False)))
        assert len(kept) == best
    a, b = "the quick brown fox jumps over the lazy dog".split(), "a quick red fox jumps over the dog".split()
    pairs = license_scan.align(a, b)
    assert [(a[x], b[y]) for x, y in pairs] == [(w, w) for w in ["quick", "fox", "jumps", "over", "the", "dog"]]
    text = "x " * 300 + license_scan.TEMPLATES["GPL-2.0"].replace("program", "tool") + " y" * 300
    found = license_scan.Licenses().find(text)
    assert [f.template for f in found] == ["GPL-2.0"] and found[0].begin >= 600
    assert license_scan.Licenses().find(None) == license_scan.Licenses().find("all the rights") == []


def test_licenses_of_one_family_are_told_apart():
    """Each notice alone is found as itself, also with words put in and changed around it."""
    known = license_scan.Licenses()
    gnu = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    for text, name in ((gnu.format("", 3), "GPL-3.0"), (gnu.format("", 2), "GPL-2.0"), (gnu.format("Affero ", 3), "AGPL-3.0"), (gnu.format("Lesser ", 3), "LGPL-3.0"), (gnu.format("Lesser ", "2.1"), "LGPL-2.1")):
        assert [f.template.removesuffix("-header").removesuffix("-program") for f in known.find(text)] == [name]
    for name, text in license_scan.TEMPLATES.items():
        found = known.find(f"x {text} y")
        assert [(f.template.removesuffix("-header"), f.coverage) for f in found] == [(name.removesuffix("-header"), 1)], name
    whole = license_scan.TEMPLATES["BSD-3-Clause"].replace("the copyright holder nor", "Example Ltd nor")
    assert [f.template for f in known.find(whole)] == ["BSD-3-Clause"]


def test_expectation_maximisation_tells_labelers_apart():
    rng = random.Random(7)
    counts: dict = {}
    truth: dict = {}
    for _ in range(4000):
        y = rng.random() < 0.3
        votes = tuple((1 if rng.random() < p else -1) if y else (1 if rng.random() < 1 - q else -1) for p, q in ((0.95, 0.97), (0.8, 0.85), (0.6, 0.6), (0.9, 0.9)))
        counts[votes] = counts.get(votes, 0) + 1
        truth.setdefault(votes, []).append(y)
    post = personal_data.reliabilities([("k", v, n) for v, n in sorted(counts.items())])
    right = sum(sum(t == (post["k", v] > 0.5) for t in ts) for v, ts in truth.items())
    assert right / 4000 > 0.95
    weight = personal_data.train([("k", v, 0, n, post["k", v]) for v, n in sorted(counts.items())])
    score = lambda v: sum(weight.get(f, 0) for f in personal_data.features("k", v, 0))
    assert sum(n for v, n in counts.items() if (score(v) > 0) == (post["k", v] > 0.5)) / 4000 > 0.97


def test_bagminhash_estimates_the_weighted_similarity():
    rng = np.random.default_rng(0)
    shingle = rng.integers(1, 1 << 60, 300).astype(np.uint64)
    a = rng.integers(1, 6, 300)
    b = a.copy()
    b[:60] = rng.integers(0, 9, 60)
    has = b > 0
    text = np.concatenate([np.zeros(300, int), np.ones(has.sum(), int)])
    names = bagminhash(text, np.concatenate([shingle, shingle[has]]), np.concatenate([a, b[has]]), 3, 4096)
    assert abs((names[0] == names[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03
    assert not names[2].any()  # a text without shingles


def test_components_and_buckets(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(k, k + 1) for k in range(100, 130)] + [(5, 5)]
    u = brute.Union(131)
    for a, b in edges:
        u.join(a, b)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: u.find(x) for e in edges for x in e if u.find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    # two families in one bucket: the hub of the one doesn't hide the other
    buckets = spark.createDataFrame([(1, k) for k in range(20)], "bucket long, uid long")
    roots = link_buckets(buckets, lambda p: p.withColumn("ok", p["a"] % 2 == p["b"] % 2), "test", 3)
    assert {r["node"]: r["root"] for r in roots.collect()} == {k: k % 2 for k in range(2, 20)}


def test_buckets_of_many_families(spark, monkeypatch):
    """One large family, thirty of two and single members in one bucket: every alike pair is linked."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(components_module, "GROUP", 3)
    rng = random.Random(4)
    sets = [{*range(1000, 1040), *rng.sample(range(10**6), 2)} for _ in range(40)]
    for k in range(30):  # half of each is common to all families
        own = [*range(20), *range(2000 + 100 * k, 2020 + 100 * k)]
        sets += [set(own), {*own[1:], 5000 + k}]
    sets += [{*range(20), *rng.sample(range(10**6), 20)} for _ in range(20)]
    order = rng.sample(range(len(sets)), len(sets))
    sets = [sets[k] for k in order]
    u = brute.Union(len(sets))
    for a, x in enumerate(sets):
        for b in range(a):
            if len(x & sets[b]) >= 0.8 * len(x | sets[b]):
                u.join(a, b)
    frame = spark.createDataFrame([(k, sorted(x)) for k, x in enumerate(sets)], "uid long, elements array<long>").cache()

    def verify(pairs):
        both = pairs.join(frame.select(F.col("uid").alias("a"), F.col("elements").alias("x")), "a").join(frame.select(F.col("uid").alias("b"), F.col("elements").alias("y")), "b")
        return both.select("a", "b", (F.size(F.array_intersect("x", "y")) >= 0.8 * F.size(F.array_union("x", "y"))).alias("ok"))

    buckets = spark.createDataFrame([(1, k) for k in range(len(sets))], "bucket long, uid long")
    for more in ((), (lambda rest: frame.join(rest, "uid").select("uid", "root", "elements"), 0.8)):
        roots = link_buckets(buckets, verify, "many", 2, *more)
        assert {r["node"]: r["root"] for r in roots.collect()} == {k: u.find(k) for k in range(len(sets)) if u.find(k) != k}


def test_sieve_lets_every_key_pass(spark):
    from pyspark.sql import functions as F

    rows = spark.range(2000).withColumn("h", F.when(F.col("id") == 7, None).otherwise(F.xxhash64("id")))
    keys = rows.where("id % 10 = 0 and id != 7").select("h")
    some, none = parted(rows, F.col("h"), sieve(keys, F.col("h")))
    assert some.columns == rows.columns and some.count() + none.count() == 2000
    passed = {r["id"] for r in some.collect()}
    assert {k for k in range(2000) if k % 10 == 0} <= passed and 7 not in passed and len(passed) < 260
