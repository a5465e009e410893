"""Landing and Bronze reads: the events are parsed once for the shapes that need their study slot, and a
load's cut-off prunes Bronze partitions."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from cohortflow.operators import watermark as WM
from cohortflow.plans.pipeline import FROM_SLOTS, Landed
from cohortflow.sources import fixtures as FX


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _tables(spark, path):
    at = dt.datetime(2024, 1, 1)
    events = [(n, at + dt.timedelta(hours=n), 10 + n % 3, "view", float(n), p) for n, p in enumerate(
        ['{"k": 3}', '{"k": 8}', '{"k": 3}', "{}", None, "no json", '{"k": 12}', '{"k": 3}', '{"k": 3}'] * 3)]
    events.append(events[0])  # a repeated row
    events.append((99, None, None, "view", None, '{"k": 1}'))
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{path}/events.parquet")
    customers = [(10, 1, "BUILDING", 5.0), (11, 2, "MACHINERY", -5.0), (12, None, None, None), (13, 3, "BUILDING", 1.0)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey long, c_mktsegment string, c_acctbal double").write.parquet(f"{path}/customer.parquet")


def test_stored_landing_parses_events_once(spark, tmp_dir):
    _tables(spark, f"{tmp_dir}/sf")
    lazy, stored = Landed(spark, f"{tmp_dir}/sf"), Landed(spark, f"{tmp_dir}/sf", f"{tmp_dir}/store")
    stored.prefetch(FROM_SLOTS)
    for name in FROM_SLOTS:
        assert "get_json_object" in plan(lazy._build(name))
        assert "get_json_object" not in plan(stored._build(name))
        assert stored[name].count() > 0
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, lazy[name].collect()))


def test_event_slots_keep_every_event(spark, tmp_dir):
    _tables(spark, f"{tmp_dir}/sf")
    tables = Landed(spark, f"{tmp_dir}/sf").tables
    assert FX.event_slots(tables).count() == tables["events"].count() == 29


def test_cut_off_prunes_later_bronze_partitions(spark, tmp_dir):
    stamps = [(i, dt.datetime(2024, 1, 15) + dt.timedelta(days=i // 2, hours=i)) for i in range(8)] + [(9, None)]
    rows = spark.createDataFrame(stamps, "id int, _ingest_ts timestamp").withColumn("_ingest_date", F.to_date("_ingest_ts"))
    rows.write.partitionBy("_ingest_date").parquet(f"{tmp_dir}/bronze")
    bronze, last = spark.read.parquet(f"{tmp_dir}/bronze"), stamps[4][1]
    seen = WM.until(bronze, "_ingest_ts", last)
    assert "_ingest_date" in plan(seen).split("PartitionFilters")[1].split("PushedFilters")[0].replace("isnotnull(_ingest_date", "")
    assert sorted(r["id"] for r in seen.collect()) == [0, 1, 2, 3, 4]
    assert sorted(r["id"] for r in WM.until(bronze.drop("_ingest_date"), "_ingest_ts", last).collect()) == [0, 1, 2, 3, 4]
