"""Malformed records and failed casts: kept out, reported, and not in the way of the rest (S-01, F-01, S-05)."""

import contextlib
import io
import os

from cohortflow.plans import medallion as MD
from cohortflow.sources import landing as LD
from cohortflow.sources import quarantine as QU

HEADER = "patient_id,study_id,site_id,stage,event_date"
LINES = ["P1,S1,X1,lead,2024-01-05", "P2,S1,X1,lead", "P3,S1,X1,lead,2024-01-06,more,still", "P4,S1,X1,lead,some day", '"P5","S1","X,1",lead,2024-01-07', "P6,S1,,lead,"]


def write(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([header, *lines]) + "\n")


def test_faults_of_a_file(spark, tmp_dir):
    write(f"{tmp_dir}/fe/a.csv", HEADER, LINES)
    rows = QU.read_checked(spark, f"{tmp_dir}/fe", "funnel_events")
    assert sorted(r["patient_id"] for r in QU.wellformed(rows).collect()) == ["P1", "P4", "P5", "P6"]
    found = sorted(map(tuple, QU.rejects(rows, "funnel_events").collect()))
    assert all(f[1].endswith("/fe/a.csv") for f in found)
    assert [f[2:] for f in found] == [("cast", "event_date", "some day", None), ("malformed", None, None, LINES[1]), ("malformed", None, None, LINES[2])]


def test_clean_and_empty_files_have_no_faults(spark, tmp_dir):
    write(f"{tmp_dir}/fe/a.csv", HEADER, [LINES[0], LINES[4]])
    write(f"{tmp_dir}/fe/b.csv", HEADER, [])
    rows = QU.read_checked(spark, f"{tmp_dir}/fe", "funnel_events")
    assert rows.count() == 2 and QU.rejects(rows, "funnel_events").count() == 0
    assert QU.rejects(rows, "funnel_events").columns == QU.COLUMNS


def test_streamed_load_with_faults(spark, tmp_dir):
    lake = MD.Lake(spark, f"{tmp_dir}/lake")
    assert lake.rejects("funnel_events").count() == 0
    write(f"{tmp_dir}/landing/funnel_events/load_1/a.csv", HEADER, LINES)
    write(f"{tmp_dir}/landing/patients/load_1/a.csv", "patient_id,study_id,site_id,age,sex,race_ethnicity,is_rural", ["P1,S1,X1,thirty,Female,White,maybe", "P2,S1"])
    MD.ingest_bronze(spark, f"{tmp_dir}/landing", lake, ["patients", "funnel_events"])
    MD.silver_run(spark, lake, "b1")
    assert sorted(r["patient_id"] for r in lake.silver().table("funnel_events").collect()) == ["P1", "P4", "P5", "P6"]
    assert [(r["patient_id"], r["age"]) for r in lake.silver().table("dim_patient").collect()] == [("P1", None)]
    assert sorted((r["reason"], r["field"]) for r in lake.rejects("patients").collect() if r["reason"] == "cast") == [("cast", "age"), ("cast", "is_rural")]
    assert [r["record"] for r in lake.rejects("patients").collect() if r["reason"] == "malformed"] == ["P2,S1"]
    assert lake.rejects("funnel_events").filter("reason = 'malformed'").count() == 2
    MD.ingest_bronze(spark, f"{tmp_dir}/landing", lake, ["patients", "funnel_events"])
    assert lake.rejects("funnel_events").count() == 3  # a further run of the stream adds nothing


def test_one_scan_for_three_header_versions(spark, tmp_dir):
    cols = "study_id,protocol_number,sponsor,therapeutic_area,phase,target_enrollment,planned_duration_days,start_date"
    row = "P1,Sp,Onc,Phase I,10,100,2024-01-01"
    write(f"{tmp_dir}/s/a.csv", cols, [f"S1,{row}"])
    write(f"{tmp_dir}/s/b.csv", "status," + cols, [f"open,S2,{row}", f"short,S4,{row[:-11]}"])
    write(f"{tmp_dir}/s/c.csv", cols + ",status,country", [f"S3,{row},closed,DE"])
    df = LD.read_evolving(spark, f"{tmp_dir}/s", "studies")
    got = {r["study_id"]: r for r in df.collect()}
    assert df.columns == [*cols.split(","), "status", "country"] or df.columns == [*cols.split(","), "country", "status"]
    assert {k: (r["status"], r["country"], r["target_enrollment"]) for k, r in got.items()} == {"S1": (None, None, "10"), "S2": ("open", None, "10"), "S3": ("closed", "DE", "10"), "S4": ("short", None, "10")}
    assert got["S4"]["start_date"] is None
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        LD.read_evolving(spark, f"{tmp_dir}/s", "studies").explain()
    assert buf.getvalue().count("FileScan csv") == 1


def test_quoted_line_feeds_where_asked_for(spark, tmp_dir):
    cols = "study_id,protocol_number,sponsor,therapeutic_area,phase,target_enrollment,planned_duration_days,start_date"
    write(f"{tmp_dir}/s/a.csv", cols, ['S1,P1,"Sp\nof two lines",Onc,Phase I,10,100,2024-01-01'])
    write(f"{tmp_dir}/s/b.csv", "status," + cols, ["open,S2,P1,Sp,Onc,Phase I,10,100,2024-01-01"])
    got = {r["study_id"]: r for r in LD.read_evolving(spark, f"{tmp_dir}/s", "studies", multi_line=True).collect()}
    assert got["S1"]["sponsor"] == "Sp\nof two lines" and got["S2"]["status"] == "open" and len(got) == 2
