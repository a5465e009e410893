"""Mergeable distinct states, and a row filter that prunes partitions."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import governance as GV
from cohortflow.plans import distinct as DI

SCHEMA = "patient_id string, study_id string, site_id string, enrolled_date date"


def rows(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, *(f"P{k}" for k in range(400))]), f"S{rng.randint(1, 4)}", rng.choice([None, "X1", "X2", "X3"]),
             rng.choice([None, dt.date(2024, 1, rng.randint(1, 28))])) for _ in range(n)]


@pytest.fixture(scope="module")
def two_loads(spark):
    one, two = rows(1, 600), rows(2, 500)
    a, b = (spark.createDataFrame(r, SCHEMA) for r in (one, two))
    first = DI.numbered(a.select("patient_id"))
    both = DI.numbered(b.select("patient_id"), first)
    return a.unionByName(b), first, both, DI.merged(DI.states(a, first), DI.states(b, both))


def test_numbers_stay_and_are_unique(two_loads):
    _, first, both, _ = two_loads
    old = {r["value"]: r["number"] for r in first.collect()}
    new = {r["value"]: r["number"] for r in both.collect()}
    assert old.items() <= new.items() and len(set(new.values())) == len(new) and None not in new
    assert max(new.values()) < DI.BUCKETS * len(new)


@pytest.mark.parametrize("group_by, where", [([], "true"), (["study_id"], "week_start IS NOT NULL"), (["site_id", "week_start"], "study_id IN ('S1', 'S3')"), (["week_start"], "site_id = 'X2'")])
def test_counts_under_any_filter_equal_the_rows(spark, two_loads, group_by, where):
    every, _, _, state = two_loads
    state = state.where(where)
    exact = every.withColumn("week_start", F.date_trunc("week", "enrolled_date").cast("date")).where(where)
    sites = DI.numbered(every.select("site_id"))
    for got, want in ((DI.distinct_patients(state, group_by, "n"), F.count_distinct("patient_id")), (DI.distinct_values(state, group_by, "site_id", sites, "n"), F.count_distinct("site_id"))):
        want = exact.groupBy(*group_by).agg(want.alias("n"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_states_of_parts_in_any_order(two_loads, spark):
    every, _, both, state = two_loads
    whole = DI.states(every, both)
    again = DI.merged(state, state)  # a part delivered twice changes nothing
    for x in (whole, again):
        assert sorted(map(str, DI.distinct_patients(x, ["study_id"]).collect())) == sorted(map(str, DI.distinct_patients(state, ["study_id"]).collect()))


def test_row_filter_reads_granted_partitions_only(spark, tmp_path):
    fact = spark.range(2000).select(F.format_string("P%d", "id").alias("patient_id"), F.format_string("X%d", F.col("id") % 20).alias("site_id"), (F.col("id") % 7).alias("age"))
    table = GV.by_site(fact, f"{tmp_path}/fact")
    assert table.columns == fact.columns and table.exceptAll(fact).count() == 0 and table.count() == 2000
    grants = spark.createDataFrame([("a", "X3"), ("a", "X4"), ("b", "X5")], "user string, site_id string")
    members = spark.createDataFrame([("root", GV.ALL_SITES)], "user string, `group` string")
    seen = GV.row_filter(table, GV.resolve("a", members, grants))
    assert {r["site_id"] for r in seen.collect()} == {"X3", "X4"} and seen.count() == 200
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        seen.explain("formatted")
    assert "dynamicpruning" in buf.getvalue()
    assert GV.row_filter(table, GV.resolve("root", members, grants)).count() == 2000
    assert GV.row_filter(table, GV.resolve("nobody", members, grants)).count() == 0
