"""Operator unit tests on tiny hand-made frames: ties, NULLs, late rows, replay."""

import datetime as dt

from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.functions.scalar import padded_id, pct, safe_div
from cohortflow.operators import watermark as WM
from cohortflow.operators.aggregates import count_if, groups_with_more_than, share_of_partition
from cohortflow.operators.dedup import first_k_per_group, first_per_key, removed_duplicates
from cohortflow.operators.pivot import milestone_pivot, representative
from cohortflow.operators.scd2 import scd2_apply, scd2_initial, surrogate_key
from cohortflow.operators.upsert import first_wins_upsert
from cohortflow.sources.schemas import DIM_PATIENT_SCHEMA

D = dt.date
T = dt.datetime


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_first_per_key_tie_break_is_deterministic(spark):
    df = spark.createDataFrame([("p", "lead", D(2024, 1, 2), "S2"), ("p", "lead", D(2024, 1, 2), "S1"),
                                ("p", "lead", D(2024, 1, 3), "S0"), ("q", "lead", None, "S9")],
                               "patient_id string, stage string, event_date date, site_id string")
    out = first_per_key(df, ["patient_id", "stage"], ["event_date"])
    assert rows(out, "patient_id") == [("p", "lead", D(2024, 1, 2), "S1"), ("q", "lead", None, "S9")]
    assert removed_duplicates(df, ["patient_id", "stage"], ["event_date"]).count() == 2


def test_first_per_key_order_on_key_column(spark):
    df = spark.createDataFrame([("p", "A", 2), ("p", "A", 1)], "k string, s string, v int")
    out = first_per_key(df, ["k", "s"], ["v", "s"])
    assert rows(out) == [("p", "A", 1)]


def test_first_k_per_group_ranks(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1)], "g string, x int")
    out = first_k_per_group(df, ["g"], ["x"], 3, "n")
    assert rows(out, "g", "x") == [("a", 0, 1), ("a", 1, 2), ("a", 2, 3), ("b", 1, 1)]


def test_milestone_pivot_and_representative_site(spark):
    df = spark.createDataFrame([
        ("p", "lead", D(2024, 1, 5), "S2"), ("p", "lead", D(2024, 1, 5), "S1"),
        ("p", "enrolled", D(2024, 1, 9), "S3"), ("p", "enrolled", D(2024, 1, 7), "S4"),
    ], "patient_id string, stage string, event_date date, site_id string")
    out = milestone_pivot(df, ["patient_id"], "stage", ["lead", "consented", "enrolled"], "event_date",
                          carry={"site_id": representative("site_id", ["event_date"])})
    r = out.collect()[0]
    assert r["lead_date"] == D(2024, 1, 5) and r["consented_date"] is None and r["enrolled_date"] == D(2024, 1, 7)
    assert r["site_id"] == "S1"


def _batch(spark, data, ts):
    return spark.createDataFrame(
        [(*d, ts) for d in data],
        "patient_id string, study_id string, site_id string, age int, sex string, race_ethnicity string, "
        "is_rural boolean, _ingest_ts timestamp")


ATTRS = C.SCD2_ATTRIBUTES
TRACKED = C.SCD2_TRACKED


def test_scd2_insert_change_keep_one_timestamp(spark):
    t1, t2 = T(2024, 1, 1), T(2024, 1, 15)
    b1 = _batch(spark, [("A", "S1", "X1", 30, "Female", "White", False),
                        ("B", "S1", "X1", 40, "Male", None, True)], t1)
    dim = scd2_apply(spark.createDataFrame([], DIM_PATIENT_SCHEMA), b1, "patient_id", ATTRS, TRACKED, t1)
    assert dim.count() == 2 and dim.filter("is_current").count() == 2
    # A moves site (tracked), B gets a race where it had NULL (null-safe change), C is new,
    # and A's age changes too (untracked alone would be ignored)
    b2 = _batch(spark, [("A", "S1", "X2", 31, "Female", "White", False),
                        ("B", "S1", "X1", 40, "Male", "Asian", True),
                        ("C", "S2", "X3", 50, "Male", "White", False)], t2)
    dim2 = scd2_apply(dim, b2, "patient_id", ATTRS, TRACKED, t2)
    r = rows(dim2.select("patient_id", "site_id", "effective_from", "effective_to", "is_current"),
             "patient_id", "effective_from")
    assert r == [
        ("A", "X1", t1, t2, False), ("A", "X2", t2, None, True),
        ("B", "X1", t1, t2, False), ("B", "X1", t2, None, True),
        ("C", "X3", t2, None, True),
    ]
    # exactly one current row per key (the reference's two-statement form loses reopened rows)
    assert dim2.groupBy("patient_id").agg(count_if(F.col("is_current")).alias("c")).filter("c != 1").count() == 0
    # replay of the same batch (same or later timestamp) changes nothing
    for ts in (t2, T(2024, 1, 20)):
        again = scd2_apply(dim2, b2, "patient_id", ATTRS, TRACKED, ts)
        assert again.exceptAll(dim2).count() == 0 and dim2.exceptAll(again).count() == 0


def test_scd2_untracked_change_ignored_and_batch_made_unique(spark):
    t1, t2 = T(2024, 1, 1), T(2024, 1, 15)
    dim = scd2_initial(_batch(spark, [("A", "S1", "X1", 30, "Female", "White", False)], t1), "patient_id", ATTRS, t1)
    b2 = _batch(spark, [("A", "S1", "X1", 99, "Male", "White", False)], t2).unionByName(
        _batch(spark, [("A", "S1", "X5", 30, "Female", "White", False)], T(2024, 1, 14)))
    # the later ingest row (age/sex change only) wins and is not tracked: no new version
    dim2 = scd2_apply(dim, b2, "patient_id", ATTRS, TRACKED, t2)
    assert rows(dim2.select("site_id", "age", "is_current")) == [("X1", 30, True)]


def test_surrogate_key_is_replay_stable(spark):
    df = spark.createDataFrame([("A", T(2024, 1, 1))], "patient_id string, effective_from timestamp")
    a = df.select(surrogate_key("patient_id", F.col("effective_from"))).first()[0]
    b = df.select(surrogate_key("patient_id", F.col("effective_from"))).first()[0]
    assert a == b and len(a) == 64


def test_upsert_late_earlier_event_wins_and_is_idempotent(spark):
    schema = "patient_id string, study_id string, site_id string, stage string, event_date date"
    stored = spark.createDataFrame([("p", "S", "X1", "lead", D(2024, 1, 10))], schema)
    late = spark.createDataFrame([("p", "S", "X2", "lead", D(2024, 1, 3)), ("p", "S", "X1", "enrolled", D(2024, 1, 12))], schema)
    key, order = ["patient_id", "study_id", "stage"], ["event_date", "study_id", "site_id"]
    out = first_wins_upsert(stored, late, key, order)
    assert rows(out.select("stage", "event_date", "site_id"), "stage") == [
        ("enrolled", D(2024, 1, 12), "X1"), ("lead", D(2024, 1, 3), "X2")]
    again = first_wins_upsert(out, late, key, order)
    assert again.exceptAll(out).count() == 0 and out.exceptAll(again).count() == 0


def test_marks_default_advance_and_no_rows(spark):
    marks = WM.empty_marks(spark)
    assert WM.read_mark(marks, "t") == C.DEFAULT_MARK
    df = spark.createDataFrame([(T(2024, 1, 1),), (T(2024, 1, 5),)], "_ingest_ts timestamp")
    rows_read = WM.after_mark(df, "_ingest_ts", WM.read_mark(marks, "t"))
    marks = WM.advance(marks, "t", rows_read.agg(F.max("_ingest_ts").alias("watermark")))
    assert WM.read_mark(marks, "t") == T(2024, 1, 5)
    none = WM.after_mark(df, "_ingest_ts", WM.read_mark(marks, "t"))
    assert none.count() == 0
    marks2 = WM.advance(marks, "t", none.agg(F.max("_ingest_ts").alias("watermark")))
    assert WM.read_mark(marks2, "t") == T(2024, 1, 5)


def test_extract_since_orders_and_advances(spark):
    df = spark.createDataFrame([(3, T(2024, 1, 3)), (1, T(2024, 1, 1)), (2, T(2024, 1, 2))], "id int, modified timestamp")
    marks = WM.advance(WM.empty_marks(spark), "src", spark.createDataFrame([(T(2024, 1, 1),)], "watermark timestamp"))
    out, marks2 = WM.extract_since(df, "modified", marks, "src")
    assert [r["id"] for r in out.collect()] == [2, 3]
    assert WM.read_mark(marks2, "src") == T(2024, 1, 3)


def test_safe_div_pct_and_share(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 0)], "s string, g string, n long")
    out = share_of_partition(df, "n", ["s"], "pct")
    assert rows(out.select("s", "g", "pct"), "s", "g") == [("a", "x", 25.0), ("a", "y", 75.0), ("b", "x", None)]
    r = spark.range(1).select(safe_div(F.lit(1), F.lit(0)).alias("a"), pct(F.lit(1), F.lit(3)).alias("b")).first()
    assert r["a"] is None and r["b"] == 33.3


def test_padded_id_keeps_long_numbers(spark):
    r = spark.range(1).select(padded_id("PT-", F.lit(7), 8).alias("a"), padded_id("PT-", F.lit(1234567890), 8).alias("b")).first()
    assert r["a"] == "PT-00000007" and r["b"] == "PT-1234567890"


def test_groups_with_more_than(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(groups_with_more_than(df, ["k"], 1, "versions")) == [("a", 2)]


def test_hot_key_holding_a_third_of_rows(spark):
    """One key with a third of all rows: dedup, pivot and SCD2 stay exact (no caps, no sampling)."""
    n = 3000
    hot = [("HOT", ["lead", "consented", "enrolled"][i % 3], D(2024, 1, 1 + i % 28), f"S{i % 7}") for i in range(n // 3)]
    cold = [(f"P{i}", "lead", D(2024, 1, 1 + i % 28), f"S{i % 5}") for i in range(2 * n // 3)]
    df = spark.createDataFrame(hot + cold, "patient_id string, stage string, event_date date, site_id string").repartition(8)
    first = first_per_key(df, ["patient_id", "stage"], ["event_date", "site_id"])
    got = {(r["patient_id"], r["stage"]): (r["event_date"], r["site_id"]) for r in first.collect()}
    assert got[("HOT", "lead")] == (D(2024, 1, 1), "S0")
    assert got[("HOT", "enrolled")] == min((d, s) for p, st, d, s in hot if st == "enrolled")
    assert len(got) == 3 + 2 * n // 3
    piv = milestone_pivot(df, ["patient_id"], "stage", ["lead", "consented", "enrolled"], "event_date",
                          carry={"site_id": representative("site_id", ["event_date"])})
    h = piv.filter("patient_id = 'HOT'").first()
    assert h["lead_date"] == D(2024, 1, 1) and h["site_id"] == "S0"
    ranked = first_k_per_group(df.withColumn("g", F.lit(1)), ["patient_id"], ["event_date", "site_id", "stage"], 7, "n")
    assert ranked.filter("patient_id = 'HOT'").count() == 7


def test_small_batch_fast_path_equals_full_rewrite(spark):
    """The broadcast-keys plans (few touched keys) and the full rewrite give the same state."""
    schema = "patient_id string, study_id string, site_id string, stage string, event_date date"
    stored = spark.createDataFrame([(f"p{i}", "S", "X1", "lead", D(2024, 1, 10)) for i in range(20)]
                                   + [(None, "S", "X1", "lead", D(2024, 1, 9))], schema)
    batch = spark.createDataFrame([("p1", "S", "X2", "lead", D(2024, 1, 3)), ("p1", "S", "X1", "enrolled", D(2024, 1, 12)),
                                   ("new", "S", "X1", "lead", D(2024, 1, 4)), (None, "S", "X1", "lead", D(2024, 1, 8))], schema)
    key, order = ["patient_id", "study_id", "stage"], ["event_date", "study_id", "site_id"]
    state = first_wins_upsert(stored, batch, key, order)
    assert state.count() == 23
    got = {(r["patient_id"], r["stage"]): (r["event_date"], r["site_id"]) for r in state.collect()}
    assert got[("p1", "lead")] == (D(2024, 1, 3), "X2") and got[(None, "lead")][0] == D(2024, 1, 8)


def test_scd2_one_plan_at_every_size_and_rows_without_key(spark):
    from cohortflow.operators.scd2 import without_key

    t1, t2 = T(2024, 1, 1), T(2024, 1, 15)
    b1 = _batch(spark, [(f"A{i}", "S1", "X1", 30, "Female", "White", False) for i in range(20)] + [(None, "S1", "X1", 1, "Male", "Asian", True)], t1)
    empty = spark.createDataFrame([], DIM_PATIENT_SCHEMA)
    dim = scd2_apply(empty, b1, "patient_id", ATTRS, TRACKED, t1)
    first = scd2_initial(b1, "patient_id", ATTRS, t1)
    assert dim.count() == first.count() == 20 and dim.exceptAll(first).count() == 0
    assert without_key(b1, "patient_id").count() == 1
    b2 = _batch(spark, [("A1", "S1", "X9", 30, "Female", "White", False), ("B", "S1", "X1", 30, "Male", "Asian", True),
                        ("A2", "S1", "X1", 30, "Female", "Asian", False), ("A3", "S1", "X1", 30, "Female", "White", True),
                        (None, "S1", "X1", 1, "Male", "Asian", True)], t2)
    both = scd2_apply(dim, b2, "patient_id", ATTRS, TRACKED, t2)
    assert both.count() == 24 and both.filter("is_current").count() == 21
    assert both.filter("patient_id is null").count() == 0
    # loads less than a second apart have keys of their own
    near = scd2_apply(dim, b2, "patient_id", ATTRS, TRACKED, t1 + dt.timedelta(microseconds=800))
    assert near.select("patient_sk").distinct().count() == near.count()
