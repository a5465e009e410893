"""Fingerprints on their way through the shuffle: packed small, and the same when unpacked."""

import numpy as np
import pyarrow as pa
import pytest

from cohortflow.llm import phrases


@pytest.mark.parametrize("print_bits", [6, 11, 32, 43])
def test_packed_prints_come_back(print_bits):
    rng, rest = np.random.default_rng(print_bits), phrases._rest_bits(print_bits)
    batches, want = [], {}
    for size in (1, 7, 50_000):
        drawn = rng.integers(0, 1 << print_bits, size, dtype=np.uint64)
        edges = np.array([0, (1 << print_bits) - 1], np.uint64)
        fp = np.unique(np.concatenate([drawn, edges]))
        n = rng.choice([1, 2, 255, 256, 70_000, 1 << 31], len(fp)).astype(np.int64)
        batches.append(phrases._packed(fp, n, rest))
        for f, k in zip(fp.tolist(), n.tolist(), strict=True):
            want[f] = want.get(f, 0) + k
    table = pa.Table.from_batches(batches)
    got = {}
    for slot in set(table.column("slot").to_pylist()):
        fp, n = phrases._unpacked(table.filter(pa.compute.equal(table.column("slot"), slot)), rest)
        for f, k in zip(fp.tolist(), n.tolist(), strict=True):
            got[f] = got.get(f, 0) + k
    assert got == want


def test_a_print_takes_few_bytes():
    fp = np.unique(np.random.default_rng(1).integers(0, 1 << 32, phrases.PENDING, dtype=np.uint64))
    batch = phrases._packed(fp, np.ones(len(fp), np.int64), phrases._rest_bits(phrases.PRINT_BITS))
    lz4 = sum(pa.compress(b, codec="lz4", asbytes=True).__len__() for c in batch.columns for b in c.buffers() if b)
    assert lz4 < 3 * len(fp)


def test_counts_add_up_over_tasks_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PENDING", 40)
    words = [f"w{i % 7} x{i}" for i in range(700)]
    docs = spark.createDataFrame([(i, "en", f"{a} often. {a}") for i, a in enumerate(words)], "doc_id long, lang string, text string").repartition(6)
    found = {(r.phrase, r.n) for r in phrases.frequent_phrases(docs).where("size > 0").collect()}
    assert {("often", 700), *((f"w{k}", 200) for k in range(7))} == found
