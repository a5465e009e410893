"""Plan-shape tests: the properties the design relies on at scale."""

import contextlib
import datetime as dt
import io

from cohortflow import config as C
from cohortflow.operators.dedup import first_per_key
from cohortflow.operators.scd2 import scd2_apply, scd2_initial
from cohortflow.plans import silver as SV
from cohortflow.sources import fixtures as FX
from cohortflow.sources.driver_tables import load_tables
from table_paths import SF_SMALL


def plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode) if mode != "simple" else df.explain()
    return buf.getvalue()


def test_funnel_rank_uses_partial_group_limit_before_shuffle(spark):
    p = plan(FX.funnel_events(load_tables(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    # the partial limit sits below the exchange
    partial_at = p.index("Partial")
    assert p.rfind("Exchange hashpartitioning(user_id", 0, partial_at) != -1


def test_first_per_key_aggregates_partially(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z")], "k string, o int, v string")
    p = plan(first_per_key(df, ["k"], ["o"]))
    assert "partial_min" in p and "Window" not in p


def test_scd2_history_is_not_shuffled(spark, tmp_dir):
    t = load_tables(spark, SF_SMALL)
    d1 = scd2_initial(SV.patient(FX.patients(t)), "patient_id", C.SCD2_ATTRIBUTES, dt.datetime(2024, 1, 15))
    d1.write.mode("overwrite").parquet(f"{tmp_dir}/dim")
    dim = spark.read.parquet(f"{tmp_dir}/dim")
    # a delta extract: only the patients whose row changed
    delta = FX.patients_changed(t).join(FX.patients(t), FX.patients(t).columns, "left_anti")
    p = plan(scd2_apply(dim, SV.patient(delta), "patient_id", C.SCD2_ATTRIBUTES, C.SCD2_TRACKED,
                        dt.datetime(2024, 2, 1)))
    assert "FullOuter" in p
    lines = p.splitlines()
    # history: the first union child is a filtered scan with no exchange
    first = lines.index(next(line for line in lines if line.strip().startswith("+- Union"))) + 1
    assert "Filter" in lines[first] and "NOT is_current" in lines[first] and "FileScan" in lines[first + 1]
    assert "BroadcastHashJoin FullOuter" not in p and "_k#" not in p  # one plan, whatever the size of the batch


def test_marts_scan_only_needed_columns(spark):
    t = load_tables(spark, SF_SMALL)
    p = plan(FX.marketing_daily(t))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in p
    assert "partial_sum" in p


def test_broadcast_hint_only_after_size_check(spark):
    from cohortflow.plans.gold import bounded

    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(50).withColumnRenamed("id", "k")
    fact = spark.range(100).withColumnRenamed("id", "k")
    p_small = plan(fact.join(bounded(small, "k"), "k"), mode="extended")
    p_big = plan(fact.join(bounded(big, "k", max_rows=20), "k"), mode="extended")
    assert "broadcast" in p_small.split("== Physical Plan ==")[0].lower()
    assert "strategy=broadcast" not in p_big.split("== Physical Plan ==")[0]
    assert fact.join(bounded(big, "k", max_rows=20), "k").count() == 50


def test_cluster_conf_sizes_partitions_for_large_shuffles():
    from cohortflow.session import cluster_conf

    conf = cluster_conf(30 * 1024 ** 4)  # 30 TB of shuffle
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert parts >= 8000 and 30 * 1024 ** 4 / parts <= 256 * 1024 ** 2 + 1
    small = cluster_conf(1024 ** 3, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 40  # never below the task slots
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
