"""Each opN query against a brute-force version, over a table that holds every defined case: null, empty
and long texts, null and repeated doc_ids, equal rows, copies, and further columns with clashing names."""

import random
import tempfile
import zlib

import brute
import pytest

from cohortflow.llm import decontamination, lines, minhash_docs, packing, quality, substrings, token_files
from cohortflow.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


def rows_of_table():
    import duckdb

    base = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY doc_id LIMIT 90").fetchall()
    rng = random.Random(5)
    bits = ["password", "PassWd", "token", "api_key", "secret", "AKIA", "ABCDEF0123456789", "abcdef0123", "0123456789abcdef", ":", "=", " ", "\"", "é", "x", "\n",
            "a@b.c", "@", "x.y", "..", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (555) 123-4567", "-", "12", "_", "+", "%", "000.1.2.255", "ssn 123-45-6789 "]
    fuzz = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    bench = duckdb.sql(f"SELECT text FROM '{SMALL}/benchmark.parquet' ORDER BY item_id LIMIT 2").fetchall()
    text = base[0][1]
    one = text.split(" ")
    near = " ".join([*one[:40], "changed", *one[41:]])
    long = " ".join(f"w{k % 7000}" for k in range(20000))
    more = [None, "", " \n ", "one", "three little words", "a b c d e f g", text, near, near + " end", long, "x" * 5000, "1" * 3000, "a@" + ".b" * 3000, "a." * 4000,
            "+" + "(" * 4000, "same same " * 50, bench[0][0], "Before. " + bench[1][0].upper() + " After.", "\n".join(["A line that is said again and again."] * 4),
            "\n".join(["A line that is said again and again!", "short", "of", "", "of", "four", "four", "fours", "an other line, with words of its own"]), *fuzz]
    return [*base, *[(1000 + k, t) for k, t in enumerate(more)]]


EXTRA = [(None, "words of a document without any id, and then some more of them"), (1000, "a row of another text but a doc_id that was there"), (1020, None)]


@pytest.fixture(scope="module")
def folder(spark):
    d = tempfile.mkdtemp(prefix="cohortflow-llm-")
    rows = rows_of_table()
    table = [(i, t, "kept", 1, 2, 3, "t") for i, t in rows]
    schema = "doc_id long, text string, kept string, n_words int, uid long, h long, source string"
    spark.createDataFrame(table, schema).repartition(3).write.parquet(f"{d}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    items = [(r[0], r[1]) for r in items] + [(900, "Three little WORDS"), (901, None), (902, "  "), (903, items[0][1])]
    spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, items


@pytest.fixture(scope="module")
def answers(spark, folder):
    """Results by query, each computed once, as {doc_id: [rows]}."""
    kept = {}

    def get(name):
        if name not in kept:
            kept[name] = [r.asDict() for r in QUERIES[name](spark, folder[0]).collect()]
        return kept[name]

    return get


def test_every_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


def test_op1_base_measures(folder, answers):
    got = {r["doc_id"]: r for r in answers("op1_compression_bands")}
    for doc_id, text in folder[1]:
        r = got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute.quality(text)
        assert not (r["kept"] and r["base_failed"])


def test_op1_bands():
    import os

    import zstandard

    compress = zstandard.ZstdCompressor(level=3).compress
    rng = random.Random(1)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)).encode()
    assert quality.bands_verdict(prose, compress)[3]
    assert not quality.bands_verdict(b"spam " * 1000, compress)[3]
    assert not quality.bands_verdict(os.urandom(3000), compress)[3]
    assert not quality.bands_verdict(prose[:9000] + b"spam " * 8000, compress)[3]  # most chunks repeat
    assert quality.bands_verdict(b"tiny", compress) == (None, 0, 0, True)


def test_op1_noise_of_letters_and_digits():
    import base64
    import string

    import zstandard

    compress, rng = zstandard.ZstdCompressor(level=3).compress, random.Random(6)

    signs, often = [chr(0x4E00 + rng.randrange(0x5000)) for _ in range(2500)], [1 / (k + 8) for k in range(2500)]

    def spaced(letters, n):
        return " ".join("".join(rng.choices(letters, k=rng.randint(3, 10))) for _ in range(n // 4))[:n].encode()

    for n in (256, 399, 400, 799, 800, 1024, 1500, 2047, 2048, 4096, 8192, 30_000, 65_536):
        coded = base64.b64encode(rng.randbytes(n)).decode()
        coded = "\n".join(coded[k : k + 76] for k in range(0, n, 76))[:n].encode()
        assert not quality.bands_verdict(coded, compress)[3], n
        noise = spaced(string.ascii_letters + string.digits, n)
        ratio, chunks, out, good = quality.bands_verdict(noise, compress)
        assert not good and out == chunks, n
        assert quality.bands_verdict(spaced(string.ascii_lowercase, n), compress)[3], n
        wide = "".join(rng.choices(signs, often, k=n // 3)).encode()
        assert quality.bands_verdict(wide, compress)[3], n


def test_op1_long_lists_count_alike():
    rng = random.Random(2)
    words = [str(rng.randint(0, 12)) for _ in range(3000)]
    assert quality.repeated_words(words) == quality._repeated_words_long(words, 5)


def test_op2_spans(folder, answers):
    got = {r["doc_id"]: r for r in answers("op2_secret_scan")}
    for doc_id, text in folder[1]:
        *counts, digest, spans = brute.secrets(text)
        r = got[doc_id]
        assert ([r["n_assign"], r["n_access"], r["n_hex"]], r["base_sha256"]) == (counts, digest), text
        assert set(spans) <= set(r["spans"].split(","))


def test_op3_hits(folder, answers):
    want = brute.contamination(folder[1], folder[2])
    for r in answers("op3_decontamination"):
        assert tuple(r[k] for k in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == want[r["doc_id"]]
    assert any(v[4] for v in want.values())


def test_op3_without_broadcast(spark, folder, answers, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    again = QUERIES["op3_decontamination"](spark, folder[0]).collect()
    assert sorted(map(str, (r.asDict() for r in again))) == sorted(map(str, answers("op3_decontamination")))


def test_op4_round_trip(folder, answers):
    ids = dict(zip((i for i, _ in folder[1]), brute.whole_ids([t for _, t in folder[1]], token_files.END_ID), strict=True))
    at = 0
    for r in sorted(answers("op4_token_files"), key=lambda r: r["doc_id"]):
        own = ids.pop(r["doc_id"])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
    assert not ids


def test_op5_classes(folder, answers):
    rows = sorted(folder[1])
    want = brute.near_classes([t for _, t in rows])
    got = {r["doc_id"]: r for r in answers("op5_near_duplicates")}
    assert [got[i]["class_id"] for i, _ in rows] == [rows[k][0] for k in want]
    assert [got[i]["kept"] for i, _ in rows] == [k == n for n, k in enumerate(want)]


def test_op6_lines(folder, answers):
    rows = sorted(folder[1], key=lambda r: r[0])
    want = brute.kept_lines(rows)
    got = {r["doc_id"]: r for r in answers("op6_fuzzy_lines")}
    wrong = [i for (i, t), text in zip(rows, want, strict=True) if got[i]["kept_sha256"] != (None if text is None else brute.sha(text))]
    assert wrong == []
    assert all(got[i]["n_lines"] == (0 if t is None else t.count("\n") + 1) for i, t in rows)


SHAPES = [(" ", 1, 60), (" ", 2, 30), (" ", 3, 25), (" ", 4, 14), (" ", 5, 12), (" ", 6, 10), ("\t", 10, 7), (" ", 30, 5)]  # separator, words, letters a word


def test_op6_alike_lines_of_every_length(spark):
    """One character changed, in lines of one word, of few, of long words and with tabs: equal to brute force."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    rows = [(0, "ABCDEFGH\nABCDEFGHI\nabcdefghi\nabcdefgh\nbcdefghi\nqrstuvwx\npqrstuvwx")]
    for k in range(400):
        sep, n, size = SHAPES[k % len(SHAPES)]
        line = sep.join(word(size) for _ in range(n))
        at = rng.randrange(len(line))
        rows += [(2 * k + 1, line), (2 * k + 2, line[:at] + "#" + line[at + 1 :])]
    got = {r["doc_id"]: r["text"] for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.kept_lines(rows)
    assert sum(t == "" for t in want) > 300
    assert [i for (i, _), t in zip(rows, want, strict=True) if got[i] != t] == []


def test_op6_lines_of_one_template(spark):
    """Many families of two in the buckets of a phrase that all share: equal to brute force."""
    rng = random.Random(5)
    phrase = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=300))
    rows = []
    for k in range(300):
        own = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=120))
        at = [rng.randrange(120) for _ in range(7)]
        rows += [(2 * k, phrase + own), (2 * k + 1, phrase + "".join("#" if j in at else c for j, c in enumerate(own)))]
    got = {r["doc_id"]: r["text"] for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.kept_lines(rows)
    assert sum(t == "" for t in want) > 200
    assert [i for (i, _), t in zip(rows, want, strict=True) if got[i] != t] == []


def test_op7_notices(folder, answers):
    got = {r["doc_id"]: r for r in answers("op7_license_scan")}
    for doc_id, text in folder[1]:
        if text and "All rights reserved." in text:
            assert "all-rights-reserved" in got[doc_id]["licenses"]
        if not text or "icen" not in text and "rights" not in text and "domain" not in text:
            assert got[doc_id]["n_notices"] == 0


def test_op8_spans(folder, answers):
    got = {r["doc_id"]: r for r in answers("op8_personal_data")}
    for doc_id, text in folder[1]:
        *counts, digest, spans = brute.private(text)
        r = got[doc_id]
        assert ([r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]], r["base_sha256"]) == (counts, digest), text
        assert not spans or set(spans) <= set(r["spans"].split(","))


def test_op9_packing(folder, answers):
    ids = dict(zip((i for i, _ in folder[1]), brute.whole_ids([t for _, t in folder[1]], packing.END_ID), strict=True))
    rows = [tuple(r[k] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")) for r in answers("op9_best_fit_packing")]
    used = brute.check_packing(rows, ids)
    assert used <= -(-sum(map(len, ids.values())) // 2048) + 1


def test_op10_words(folder, answers):
    want = brute.substring([(i, i, t) for i, t in folder[1]])
    for r in answers("op10_substring_dedup"):
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]


def test_op10_split_shards(spark, folder, answers, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD", 2)
    again = QUERIES["op10_substring_dedup"](spark, folder[0]).collect()
    assert sorted(map(str, (r.asDict() for r in again))) == sorted(map(str, answers("op10_substring_dedup")))


@pytest.mark.parametrize("limit, value", [("BITMAP", 8), ("MANY_SHARDS", 0)])
def test_op10_by_lists(spark, folder, answers, monkeypatch, limit, value):
    """More shared anchors, or more split shards, than the bitmap's way takes: the same rows by the lists."""
    lists, taken = substrings._segments_by_lists, []
    monkeypatch.setattr(substrings, "_segments_by_lists", lambda *a, **b: taken.append(1) or lists(*a, **b))
    monkeypatch.setattr(substrings, "SHARD", 2)
    monkeypatch.setattr(substrings, limit, value)
    again = QUERIES["op10_substring_dedup"](spark, folder[0]).collect()
    assert taken
    assert sorted(map(str, (r.asDict() for r in again))) == sorted(map(str, answers("op10_substring_dedup")))


def test_repeated_rows_and_ids(spark):
    """Null and repeated doc_ids, equal rows: every row is answered, equal rows alike."""
    rows = [*EXTRA, EXTRA[0], (1, "to be or not to be that is the question here and now for all of us"), (1, "to be or not to be that is the question here and now for all of us"),
            (2, "so to be or not to be that is the question here and now for all of us")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, rows[-1][1])], "item_id long, text string")
    assert quality.measures(docs).count() == len(rows)
    assert token_files.read_token_files(spark, _written(spark, docs)).count() == len(rows)
    assert packing.pack(docs).agg({"length": "sum"}).first()[0] == sum(map(len, brute.whole_ids([t for _, t in rows], 0)))
    assert decontamination.measure(docs, items).where("contaminated").count() == 3
    kept = decontamination.remove_contaminated(docs, items)
    assert kept.columns == ["doc_id", "text"] and kept.count() == len(rows) - 3
    sub = brute.substring([(k, i, t) for k, (i, t) in enumerate(rows)])
    assert sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"]) for r in substrings.dedup(docs).collect()) == sorted(
        (rows[k][0] or -1, v[0], v[1]) for k, v in sub.items())
    assert minhash_docs.near_duplicates(docs).where("kept").count() == 4
    assert minhash_docs.one_of_each(docs).count() == 4
    assert lines.without_repeats(docs).count() == len(rows)


def _written(spark, docs):
    folder = tempfile.mkdtemp(prefix="cohortflow-llm-") + "/files"
    token_files.write_token_files(docs, folder)
    return folder


def test_empty_tables(spark, tmp_path):
    empty = f"{tmp_path}/empty"
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{empty}/conversations.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    for name, fn in QUERIES.items():
        assert fn(spark, empty).count() == 0, name
