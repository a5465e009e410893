"""Token counts against the libraries, phrases against brute force."""

import collections
import random
import re

import pytest
from brute import ASCII_LOWER

from cohortflow.llm import phrases, token_counts
from cohortflow.llm.tokens import vocab_path

FORMS = ["", " \n\t ", "Plain words, of  no note.", "PLAIN words,\tof no\n\nnote. ", "x <|endoftext|> y", "x <|ENDOFTEXT|> y", "a<|startoftext|>b", "É é é É ÉCOLE İI ſ K",
         "ΟΔΟΣ ΟΔΟΣ. σς", "1234 56.7,8 $%&", "don't I'LL we've'S", "日本語 テキスト。", " nbsp   em", "a\x1cb\x85c\x00d", "tab\x0bvt\x0cff", "🙂🙃", "W" * 5000, "no space" * 9000]


def library_counts(texts, vocab):
    if vocab.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocab)
        return [len(model.encode(t)) for t in texts]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocab)
    return [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("vocab", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, tmp_path, vocab):
    rng, vocab = random.Random(1), vocab_path(vocab)
    texts = FORMS + ["".join(rng.choice(FORMS[:16]) for _ in range(rng.randint(2, 6))) for _ in range(60)] + ["Long words. " * 100_000]
    rows = [*enumerate(texts), (5, texts[2]), (5, None), (None, texts[2]), (None, None)]
    docs = spark.createDataFrame([(i, t, b"x", 1, 2) for i, t in rows], "doc_id long, text string, digest binary, n_tokens int, copies int").repartition(5)
    want = sorted(zip([-1 if i is None else i for i, _ in rows], [len((t or "").encode()) for _, t in rows], library_counts([t or "" for _, t in rows], vocab), strict=True))
    for _ in range(2):  # a cold cache, then a full one
        got = token_counts.count_tokens(docs, f"{tmp_path}/cache", vocab).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_only_distinct_misses_are_encoded(spark, tmp_path):
    cache, vocab = f"{tmp_path}/cache", vocab_path()
    version = token_counts.tokenizer_digest(vocab)

    def stored():
        return spark.read.parquet(f"{cache}/tokenizer={version}").count()

    first = spark.createDataFrame([(k, "The same text.") for k in range(400)] + [(500, "the  SAME text."), (501, "An other one.")], "doc_id long, text string")
    assert token_counts.count_tokens(first, cache).count() == 402
    assert stored() == 2
    second = spark.createDataFrame([(1, "The same text."), (2, "A third text."), (3, "A third text.")], "doc_id long, text string")
    # a stored count is taken as it is: one that no tokenizer gives shows that it wasn't encoded again
    assert len({r.n_tokens for r in token_counts.count_tokens(second, cache).collect()}) <= 2
    assert stored() == 3
    spark.read.parquet(f"{cache}/tokenizer={version}").selectExpr("digest", "77L AS n_tokens").write.parquet(f"{tmp_path}/other/tokenizer={version}")
    assert {r.n_tokens for r in token_counts.count_tokens(second, f"{tmp_path}/other").collect()} == {77}
    # digests stored twice, as by two runs at the same time, are read once
    spark.read.parquet(f"{cache}/tokenizer={version}").write.mode("append").parquet(f"{tmp_path}/other/tokenizer={version}")
    assert token_counts.count_tokens(second, f"{tmp_path}/other").count() == 3


def test_versions_keep_apart():
    assert len({token_counts.tokenizer_digest(vocab_path(v)) for v in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")}) == 3


def collocations(rows, top=2000):
    """The contract over rows (lang, text)."""
    n, f = collections.Counter(), collections.defaultdict(collections.Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= 30}
        gone = set()
        for p, a in found.items():
            for k in range(2, len(p)):
                gone |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * a >= 80 * found[p[i : i + k]]}
        best = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(8)
    words = ["alpha", "Beta", "GAMMA", "delta", "été", "ÉTÉ", "x y", "日本", "of", "the", "-", "z\x85"]
    rows = [(None, None), ("en", ""), ("en", " \t "), ("en", "?!.,"), (None, "one word"), ("und", "one word")]
    for _ in range(2500):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(rng.randint(1, 40)))
        rows.append((rng.choice(["en", "en", "fr", None, "und", "x\ny"]), text))
    rows += [("en", "of the of the of the of the " * 20)] * 40 + [("fr", "New York City Hall is in New York. ")] * 35
    return rows


@pytest.mark.parametrize("print_bits", [phrases.PRINT_BITS, 6])
def test_op13_equals_brute_force(spark, talk, print_bits):
    """With fingerprints of six bits nearly all phrases collide, and the result is the same."""
    docs = spark.createDataFrame([(k, *r, 1, "x") for k, r in enumerate(talk)], "doc_id long, lang string, text string, n int, phrase string").repartition(4)
    frequent = phrases.frequent_phrases(docs, print_bits=print_bits)
    got = sorted(tuple(r)[:8] for r in phrases.collocations(frequent).collect())
    assert got == collocations(talk) and len(got) > 50
    top = sorted(tuple(r)[:8] for r in phrases.collocations(frequent, 5).collect())
    assert top == collocations(talk, 5)


def test_op13_pointers_point_to_the_first_document(spark, talk):
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(talk)], "doc_id long, lang string, text string").repartition(4)
    found = phrases.frequent_phrases(docs).where("size > 0").collect()
    assert found
    runs = []
    for lang, text in talk:
        pieces = re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER))
        w = [re.findall(r"[^\x20\x09]+", p) for p in pieces]
        runs.append(("und" if lang is None else lang, {" ".join(p[i : i + k]) for p in w for k in range(1, 5) for i in range(len(p) - k + 1)}))
    for r in found:
        assert r.first_doc == next(k for k, (lang, has) in enumerate(runs) if lang == r.lang and r.phrase in has)


def test_words_of_one_hash_are_told_apart():
    from cohortflow.llm.word_hashes import SpanHasher

    texts = [b"aa bb aa cc dd bb ee ff gg aa"]
    block = phrases.Block(texts, ["en"], SpanHasher(), print_bits=1)
    exact = block.exact_words().tolist()
    words = texts[0].split()
    assert all((exact[i] == exact[j]) == (words[i] == words[j]) for i in range(10) for j in range(10))


def test_long_and_repeated_rows(spark):
    text = "no stops here at all " * 60_000
    docs = spark.createDataFrame([(1, "en", text), (1, "en", text), (None, "en", "at all")], "doc_id long, lang string, text string")
    got = sorted(tuple(r)[:8] for r in phrases.collocations(phrases.frequent_phrases(docs)).collect())
    assert got == collocations([("en", text), ("en", text), ("en", "at all")])


def test_long_texts_in_parts(spark):
    """Texts beyond a part are cut where no phrase goes on, and their words go on counting."""
    rng = random.Random(9)
    text = "".join(rng.choice(["alpha beta", "gamma", "delta of the"]) + rng.choice([" ", " ", ". ", "\n", "!"]) for _ in range(400_000))
    assert len(text) > phrases.AT_ONCE and len(list(phrases._parted(text.encode()))) > 1
    frequent = phrases.frequent_phrases(spark.createDataFrame([(1, "en", text), (-7, "en", "alpha beta gamma delta")], "doc_id long, lang string, text string"))
    assert sorted(tuple(r)[:8] for r in phrases.collocations(frequent).collect()) == collocations([("en", text), ("en", "alpha beta gamma delta")])
    assert len(list(phrases._parted(b"x" * (phrases.AT_ONCE * 2)))) == 1
    assert {r.first_doc for r in frequent.collect() if r.phrase == "alpha beta"} == {-7}
