"""Keyed state: by bucket and load in tables, in the state store of a stream."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from cohortflow.operators.bucketed import BucketedTable, LoadMarks
from cohortflow.operators.dedup import first_per_key
from cohortflow.operators.upsert import first_wins_upsert
from cohortflow.sources.schemas import SILVER_FUNNEL_SCHEMA
from cohortflow.streaming import incremental as INC

KEY, ORDER = ["patient_id", "study_id", "stage"], ["event_date", "site_id"]


def files(path, load=None):
    """Size by file of a table, of one load or all."""
    found = {}
    for folder, _, names in os.walk(path):
        if load is None or folder.endswith(f"load={load}"):
            found |= {f"{folder}/{n}": os.path.getsize(f"{folder}/{n}") for n in names if n.endswith(".parquet")}
    return found


def events(spark, rows):
    return spark.createDataFrame([(p, s, x, g, dt.date(2024, 1, 1) + dt.timedelta(d)) for p, s, x, g, d in rows], SILVER_FUNNEL_SCHEMA)


def upsert(stored, batch):
    return first_wins_upsert(stored, batch, KEY, ORDER)


@pytest.fixture()
def table(spark, tmp_dir):
    t = BucketedTable(spark, f"{tmp_dir}/funnel", SILVER_FUNNEL_SCHEMA, ["patient_id"], 100)
    many = spark.range(20000).select(F.format_string("P%05d", "id").alias("patient_id"), F.lit("S1").alias("study_id"), F.lit("X1").alias("site_id"),
                                     F.lit("lead").alias("stage"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("event_date"))
    assert len(t.merge(many, upsert, 1)) == 100
    return t


def test_a_load_writes_the_buckets_it_touches(spark, table):
    late = events(spark, [("P00007", "S1", "X2", "lead", -5)])
    assert len(table.merge(late, upsert, 2)) == 1
    first, second = sum(files(table.path, 1).values()), sum(files(table.path, 2).values())
    assert second < 0.02 * first
    assert len(table.latest()) == 100 and sorted(set(table.latest().values())) == [1, 2]
    now, before = table.read().filter("patient_id = 'P00007'").first(), table.read(1).filter("patient_id = 'P00007'").first()
    assert (str(now["event_date"]), now["site_id"]) == ("2023-12-27", "X2") and before["site_id"] == "X1"
    assert table.read().count() == table.read(1).count() == 20000


def test_a_repeated_load_changes_nothing(spark, table):
    late = events(spark, [("P00007", "S1", "X2", "lead", -5), ("Q1", "S1", "X1", "lead", 1)])
    table.merge(late, upsert, 2)
    rows = sorted(map(tuple, table.read().collect()))
    size = files(table.path, 2)
    table.merge(late, upsert, 2)  # the same load once more, as after a crash
    assert sorted(map(tuple, table.read().collect())) == rows
    assert sorted(size.values()) == sorted(files(table.path, 2).values())
    table.merge(late, upsert, 3)  # the same rows in a further load
    assert sorted(map(tuple, table.read().collect())) == rows
    assert {r["load"]: r["rows"] for r in table.rows_by_load().collect()} == {1: 20000, 2: 20001, 3: 20001}


def test_loads_equal_one_shot(spark, tmp_dir):
    rng = random.Random(2)
    t = BucketedTable(spark, f"{tmp_dir}/t", SILVER_FUNNEL_SCHEMA, ["patient_id"], 7)
    every = []
    for load in range(1, 6):
        rows = [(rng.choice([None, *(f"P{k}" for k in range(30))]), "S1", f"X{rng.randint(1, 3)}", rng.choice(["lead", None]), rng.randint(0, 90)) for _ in range(25)]
        every += rows
        t.merge(events(spark, rows), upsert, load)
        one_shot = first_per_key(events(spark, every), KEY, ORDER)
        assert sorted(map(str, t.read().collect())) == sorted(map(str, one_shot.collect()))
    assert t.merge(events(spark, []), upsert, 6) == [] and max(t.latest().values()) == 5


def test_lookup_reads_one_bucket(spark, table):
    found = table.lookup("P00123")
    assert [r["patient_id"] for r in found.collect()] == ["P00123"]
    assert len(found.inputFiles()) == 1 and table.lookup("nobody").count() == 0
    assert "EqualTo(patient_id,P00123)" in found._jdf.queryExecution().toString()


def test_empty_table(spark, tmp_dir):
    t = BucketedTable(spark, f"{tmp_dir}/none", SILVER_FUNNEL_SCHEMA, ["patient_id"], 4)
    assert t.latest() == {} and t.read().count() == 0 and t.read().schema == SILVER_FUNNEL_SCHEMA and t.rows_by_load().count() == 0


def test_marks_by_load(spark, tmp_dir):
    m = LoadMarks(spark, f"{tmp_dir}/marks")
    assert m.last() == 0 and m.read().count() == 0 and m.load_of("a") is None
    one = spark.createDataFrame([("t", dt.datetime(2024, 1, 1))], "table_name string, watermark timestamp")
    m.write(one, 1, "a")
    m.write(one.limit(0), 2, "b")  # a load that read nothing counts
    assert m.last() == 2 and m.load_of("a") == 1 and m.load_of("b") == 2 and m.read(1).count() == 1 and m.read().count() == 0


def _bronze(spark, path, rows, ts):
    df = events(spark, rows).select(*[F.col(c).cast("string") for c in SILVER_FUNNEL_SCHEMA.names])
    df.withColumn("_ingest_ts", F.lit(ts).cast("timestamp")).withColumn("_source_file", F.lit("f")).withColumn("_ingest_date", F.to_date(F.lit(ts))).coalesce(1).write.mode("append").partitionBy("_ingest_date").parquet(path)


def test_stream_writes_changed_keys_only(spark, tmp_dir):
    bronze, out, ckpt = f"{tmp_dir}/bronze", f"{tmp_dir}/changes", f"{tmp_dir}/ckpt"
    loads = [[(f"P{k}", "S1", "X1", "lead", 50 + k) for k in range(40)],
             # P0 to P9 again and later (unchanged), P10 to P14 earlier, two new keys
             [*[(f"P{k}", "S1", "X2", "lead", 300) for k in range(10)], *[(f"P{k}", "S1", "X3", "lead", 1) for k in range(10, 15)], ("P40", "S1", "X1", "lead", 9), ("P0", "S1", "X1", "consented", 9)],
             [("P3", "S1", "X9", "lead", 0), ("P12", "S1", "X9", "lead", 2), (None, "S1", "X9", "lead", 2)]]
    every, want = [], [40, 7, 2]
    for k, rows in enumerate(loads):
        every += rows
        _bronze(spark, bronze, rows, f"2024-01-0{k + 1} 00:00:00")
        INC.run_silver_funnel(spark, bronze, out, ckpt)
        one_shot = first_per_key(events(spark, every), KEY, ORDER)
        assert sorted(map(str, INC.silver_funnel(spark, out).collect())) == sorted(map(str, one_shot.collect()))
        by_batch = {r["batch"]: r["count"] for r in INC.changes(spark, out).groupBy("batch").count().collect()}
        assert by_batch == dict(enumerate(want[: k + 1]))
    INC.run_silver_funnel(spark, bronze, out, ckpt)
    assert INC.changes(spark, out).count() == 49
    states = [n for folder, _, names in os.walk(f"{ckpt}/state") for n in names]
    assert any(n.endswith(".changelog") for n in states) or any(n.endswith(".zip") for n in states)  # RocksDB's files


def test_stream_in_small_batches(spark, tmp_dir):
    """A load split over several micro-batches (one arrival time in all of them) loses no change."""
    bronze, out, ckpt = f"{tmp_dir}/bronze", f"{tmp_dir}/changes", f"{tmp_dir}/ckpt"
    every = []
    for k in range(4):
        rows = [(f"P{j}", "S1", f"X{k}", "lead", 10 * (4 - k) + j) for j in range(6)]
        every += rows
        _bronze(spark, bronze, rows, "2024-01-01 00:00:00")
    INC.run_silver_funnel(spark, bronze, out, ckpt, max_bytes="1")
    assert INC.changes(spark, out).select("batch").distinct().count() == 4
    assert sorted(map(str, INC.silver_funnel(spark, out).collect())) == sorted(map(str, first_per_key(events(spark, every), KEY, ORDER).collect()))
