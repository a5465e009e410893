"""File ingest, streaming exactly-once, schema evolution, runs that stop in between."""

import os

from pyspark.sql import functions as F

from cohortflow.sources import landing as LD
from cohortflow.sources.bronze import file_ledger
from cohortflow.streaming import incremental as INC
from cohortflow.streaming import ingest as ING


def _csv(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


HDR = "patient_id,study_id,site_id,stage,event_date"


def test_stream_two_files_three_runs(spark, tmp_dir):
    land, bronze, ckpt = f"{tmp_dir}/landing/fe", f"{tmp_dir}/bronze/fe", f"{tmp_dir}/ckpt/fe"
    _csv(f"{land}/load_1/a.csv", HDR, ["P1,S1,X1,lead,2024-01-01", "P1,S1,X1,lead,2024-01-02"])
    counts = []
    ING.ingest(spark, "funnel_events", f"{land}/*/", bronze, ckpt)
    counts.append(spark.read.parquet(bronze).count())
    _csv(f"{land}/load_2/b.csv", HDR, ["P2,S1,X1,lead,2024-01-03"])
    ING.ingest(spark, "funnel_events", f"{land}/*/", bronze, ckpt)
    counts.append(spark.read.parquet(bronze).count())
    ING.ingest(spark, "funnel_events", f"{land}/*/", bronze, ckpt)
    counts.append(spark.read.parquet(bronze).count())
    assert counts == [2, 3, 3]
    b = spark.read.parquet(bronze)
    assert b.filter(F.col("_source_file").endswith("b.csv")).count() == 1
    ledger = file_ledger(spark, land, b)
    assert ledger.filter("loaded").count() == 2
    # Silver from the Bronze stream; a rerun with nothing new is a no-op
    out = f"{tmp_dir}/silver/fe"
    INC.run_silver_funnel(spark, bronze, out, f"{tmp_dir}/ckpt/silver")
    INC.run_silver_funnel(spark, bronze, out, f"{tmp_dir}/ckpt/silver")
    cur = INC.silver_funnel(spark, out)
    assert sorted((r["patient_id"], str(r["event_date"])) for r in cur.collect()) == [("P1", "2024-01-01"), ("P2", "2024-01-03")]


def test_schema_evolution_by_header(spark, tmp_dir):
    base = f"{tmp_dir}/studies"
    cols = "study_id,protocol_number,sponsor,therapeutic_area,phase,target_enrollment,planned_duration_days,start_date"
    _csv(f"{base}/a.csv", cols, ["S1,P1,Sp,Onc,Phase I,10,100,2024-01-01"])
    evolved = cols.replace("phase,", "phase,recruitment_status,")
    _csv(f"{base}/b.csv", evolved, ["S2,P2,Sp,Onc,Phase II,open,20,200,2024-02-01"])
    out = LD.read_evolving(spark, base, "studies")
    r = {x["study_id"]: x for x in out.collect()}
    assert r["S2"]["target_enrollment"] == "20" and r["S2"]["recruitment_status"] == "open"
    assert r["S1"]["target_enrollment"] == "10" and r["S1"]["recruitment_status"] is None


def test_schema_evolution_new_first_column_and_quoted_header(spark, tmp_dir):
    import pytest

    base = f"{tmp_dir}/studies"
    cols = "study_id,protocol_number,sponsor,therapeutic_area,phase,target_enrollment,planned_duration_days,start_date"
    row = "P1,Sp,Onc,Phase I,10,100,2024-01-01"
    _csv(f"{base}/a.csv", cols, [f"S1,{row}"])
    _csv(f"{base}/b.csv", "recruitment_status," + cols, [f"open,S2,{row}"])
    _csv(f"{base}/c.csv", ",".join(f'"{c.upper()}"' for c in cols.split(",")), [f"S3,{row}"])
    _csv(f"{base}/d.csv", "\ufeff" + cols, [f"S4,{row}", f"study_id,{row}"])
    out = {x["study_id"]: x for x in LD.read_evolving(spark, base, "studies").collect()}
    assert sorted(out) == ["S1", "S2", "S3", "S4", "study_id"]
    assert out["S2"]["recruitment_status"] == "open" and out["S1"]["recruitment_status"] is None
    assert all(x["target_enrollment"] == "10" and x["sponsor"] == "Sp" for x in out.values())
    _csv(f"{base}/e.csv", "protocol_number,sponsor", ["P9,Sp"])
    with pytest.raises(ValueError, match="lacks study_id"):
        LD.read_evolving(spark, base, "studies")


def test_landing_scan_rejects_moved_columns(spark, tmp_dir):
    base = f"{tmp_dir}/moved"
    _csv(f"{base}/a.csv", "study_id,sponsor,protocol_number", ["S1,Sp,P1"])
    import pytest
    with pytest.raises(Exception):
        LD.read_landing(spark, base, "studies").collect()


def test_create_if_absent(spark, tmp_dir):
    from cohortflow.sources.schemas import SILVER_FUNNEL_SCHEMA
    df = LD.create_if_absent(spark, f"{tmp_dir}/t", SILVER_FUNNEL_SCHEMA)
    assert df.count() == 0 and df.schema == SILVER_FUNNEL_SCHEMA


def test_mark_filter_prunes_bronze_partitions(spark, tmp_dir):
    import contextlib
    import io

    from cohortflow.operators import watermark as WM
    from cohortflow.plans.medallion import Lake

    land, lake = f"{tmp_dir}/landing", Lake(spark, f"{tmp_dir}/lake")
    _csv(f"{land}/funnel_events/load_1/a.csv", HDR, ["P1,S1,X1,lead,2024-01-01"])
    ING.ingest(spark, "funnel_events", f"{land}/funnel_events/*/", lake.bronze_path("funnel_events"),
               f"{tmp_dir}/ckpt")
    b = lake.bronze("funnel_events")
    mark = b.agg(F.max("_ingest_ts")).first()[0]
    out = WM.after_mark(b, "_ingest_ts", mark)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    assert "_ingest_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThan(_ingest_ts" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert out.count() == 0


PHDR = "patient_id,study_id,site_id,age,sex,race_ethnicity,is_rural"


def _lake_after_two_loads(spark, base, crash_after_state=False, retry_batch="b2"):
    from cohortflow.operators.bucketed import LoadMarks
    from cohortflow.plans import medallion as MD

    land, lake = f"{base}/landing", MD.Lake(spark, f"{base}/lake")
    _csv(f"{land}/patients/load_1/a.csv", PHDR, ["P1,S1,X1,30,Female,White,false", "P2,S1,X1,40,Male,Asian,true"])
    _csv(f"{land}/funnel_events/load_1/a.csv", HDR, ["P1,S1,X1,lead,2024-01-05", "P2,S1,X1,lead,2024-01-06"])
    MD.ingest_bronze(spark, land, lake, ["patients", "funnel_events"])
    MD.silver_run(spark, lake, "b1")
    _csv(f"{land}/patients/load_2/b.csv", PHDR, ["P1,S1,X2,30,Female,White,false", "P2,S1,X1,40,Male,Asian,true"])
    _csv(f"{land}/funnel_events/load_2/b.csv", HDR, ["P1,S1,X1,lead,2024-01-02", "P1,S1,X2,consented,2024-01-09"])
    MD.ingest_bronze(spark, land, lake, ["patients", "funnel_events"])
    if crash_after_state:
        orig = LoadMarks.write

        def failing(self, marks, load, batch_id):
            if self.path.endswith("_load_watermark"):
                raise RuntimeError("lost the driver before the marks were written")
            return orig(self, marks, load, batch_id)

        LoadMarks.write = failing
        try:
            MD.silver_run(spark, lake, "b2")
        except RuntimeError:
            pass
        finally:
            LoadMarks.write = orig
        # what the failed load wrote isn't there for readers
        assert lake.silver().table("dim_patient").count() == 2
        MD.silver_run(spark, lake, retry_batch)
    else:
        MD.silver_run(spark, lake, "b2")
    return lake


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_silver_run_survives_a_crash_between_state_and_marks(spark, tmp_dir):
    clean = _lake_after_two_loads(spark, f"{tmp_dir}/clean")
    for retry in ("b2", "b2-retry"):
        crashed = _lake_after_two_loads(spark, f"{tmp_dir}/crash-{retry}", crash_after_state=True, retry_batch=retry)
        for t in ("funnel_events", "dim_patient"):
            a = clean.silver().table(t)
            b = crashed.silver().table(t)
            cols = [c for c in a.columns if c not in ("effective_from", "effective_to", "patient_sk")]
            assert _same(a.select(cols), b.select(cols)), (retry, t)
        # the late, earlier lead event replaced the stored one; P1 moved site: two versions
        f = {(r["patient_id"], r["stage"]): str(r["event_date"]) for r in crashed.silver().table("funnel_events").collect()}
        assert f[("P1", "lead")] == "2024-01-02"
        d = crashed.silver().table("dim_patient")
        assert d.filter("patient_id = 'P1'").count() == 2 and d.filter("patient_id = 'P2'").count() == 1
        assert d.filter("is_current").count() == 2


def test_retry_does_not_pass_rows_that_landed_after_the_crash(spark, tmp_dir):
    from cohortflow.operators.bucketed import LoadMarks
    from cohortflow.plans import medallion as MD

    land, lake = f"{tmp_dir}/landing", MD.Lake(spark, f"{tmp_dir}/lake")
    sources = ["patients", "funnel_events"]

    def load(n, patient, site):
        _csv(f"{land}/patients/load_{n}/a.csv", PHDR, [f"{patient},S1,{site},30,Female,White,false"])
        _csv(f"{land}/funnel_events/load_{n}/a.csv", HDR, [f"{patient},S1,{site},lead,2024-01-0{n}"])
        MD.ingest_bronze(spark, land, lake, sources)

    load(1, "P1", "X1")
    orig = LoadMarks.write

    def failing(self, marks, load, batch_id):
        if self.path.endswith("_load_watermark"):
            raise RuntimeError("lost the driver")
        return orig(self, marks, load, batch_id)

    LoadMarks.write = failing
    try:
        MD.silver_run(spark, lake, "b1")
    except RuntimeError:
        pass
    finally:
        LoadMarks.write = orig
    load(2, "P2", "X1")  # lands between the crash and the retry
    MD.silver_run(spark, lake, "b1")
    MD.silver_run(spark, lake, "b2")
    for t in ("funnel_events", "dim_patient"):
        assert sorted(r[0] for r in lake.silver().table(t).select("patient_id").collect()) == ["P1", "P2"], t


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    import pytest

    from cohortflow import session

    class Context:
        master = "spark://elsewhere:7077"

        def getConf(self):
            return self

        def get(self, *_):
            return None

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Context()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
