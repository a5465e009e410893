"""Gold kept up by changes, and measures answered from the roll-up of its cells."""

import contextlib
import datetime as dt
import io
import os

import pytest

from cohortflow import config as C
from cohortflow.operators.scd2 import current_view
from cohortflow.plans import cells as CE
from cohortflow.plans import gold as G
from cohortflow.plans import kpi as K
from cohortflow.plans import measures as X
from cohortflow.plans import medallion as MD
from cohortflow.plans.pipeline import DIM_PATIENT_COLS

STAGES = ["lead", "consented", "screened", "randomized", "enrolled"]
HEADERS = {
    "studies": "study_id,protocol_number,sponsor,therapeutic_area,phase,target_enrollment,planned_duration_days,start_date",
    "sites": "site_id,site_name,site_type,region,state,activated_date,pi_name",
    "patients": "patient_id,study_id,site_id,age,sex,race_ethnicity,is_rural",
    "funnel_events": "patient_id,study_id,site_id,stage,event_date",
    "campaigns": "campaign_id,study_id,channel,geo,start_date",
    "marketing_daily": "campaign_id,study_id,activity_date,channel,spend_usd,impressions,clicks,leads",
    "study_budgets": "study_id,currency,total_budget_usd",
    "site_costs": "study_id,site_id,month,operating_cost_usd,per_visit_cost_usd",
}
STUDIES = [f"ST{k}" for k in range(4)]
SITES = [f"X{k}" for k in range(3)]


def land(base, load, rows):
    for source, lines in rows.items():
        folder = f"{base}/landing/{source}/load_{load}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/a.csv", "w") as f:
            f.write("\n".join([HEADERS[source], *lines]) + "\n")


def events(patient, study, site, n, day):
    return [f"{patient},{study},{site},{s},{dt.date(2024, 1, 1) + dt.timedelta(day + 3 * k)}" for k, s in enumerate(STAGES[:n])]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("gold"))
    people = [(f"P{k:03d}", STUDIES[k % 4], SITES[k % 3], 1 + k % 5, k % 20) for k in range(120)]
    attrs = [("Female,White,false", "Male,Asian,true", "Female,,false")[k % 3] for k in range(120)]
    land(base, 1, {
        "studies": [f"{s},PR,Sp,Onc,Phase {'I' * (1 + k % 3)},50,400,2024-01-01" for k, s in enumerate(STUDIES)],
        "sites": [f"{s},Site,{t},West,CA,2024-01-01,PI" for s, t in zip(SITES, ("community", "mobile", "fixed"), strict=True)],
        "patients": [f"{p},{s},{x},{30 + k % 7},{a}" for k, ((p, s, x, _, _), a) in enumerate(zip(people, attrs, strict=True))],
        "funnel_events": [e for p, s, x, n, d in people for e in events(p, s, x, n, d)],
        "campaigns": ["C1,ST0,Meta,West,2024-01-01"], "marketing_daily": ["C1,ST0,2024-01-02,Meta,100.5,10,2,1"],
        "study_budgets": [f"{s},USD,1000" for s in STUDIES], "site_costs": [f"ST1,{x},2024-01-01,50.25,1" for x in SITES]})
    MD.run(spark, f"{base}/landing", f"{base}/lake", "b1")
    # load 2 touches ST1 alone: an earlier enrolment, further stages, a new patient, and a changed race
    # (a patient's old row goes out of one cell and its new one into another)
    land(base, 2, {"patients": ["P001,ST1,X1,31,Male,White,true", "Q1,ST1,X2,50,Male,White,false"],
                   "funnel_events": [*events("P005", "ST1", "X2", 5, -40), *events("Q1", "ST1", "X2", 5, 2), "P001,ST1,X0,lead,2023-12-01"]})
    tables = MD.run(spark, f"{base}/landing", f"{base}/lake", "b2")
    return base, tables


def same(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def full_star(spark, base):
    lake = MD.Lake(spark, f"{base}/lake")
    star = MD.gold_star(spark, lake)
    dim = current_view(lake.silver().table("dim_patient"), DIM_PATIENT_COLS)
    fact = G.fact_patient_enrollment(lake.silver().table("funnel_events"), dim)
    return G.Lazy({**{n: (lambda n=n: star[n]) for n in MD.DIMENSIONS}, "fact_patient_enrollment": lambda: fact})


def test_marts_after_a_load_equal_a_full_rebuild(spark, lake):
    base, tables = lake
    full = full_star(spark, base)
    assert same(tables["fact_patient_enrollment"], full["fact_patient_enrollment"])
    assert same(tables["cells"], CE.cells(full["fact_patient_enrollment"]))
    for name, mart in {"kpi_speed_study": K.speed_study, "kpi_speed_site_weekly": K.speed_site_weekly, "kpi_accessibility_diversity": K.diversity,
                       "kpi_accessibility_reach": K.reach, "kpi_predictability_conversion": K.conversion, "kpi_predictability_forecast": K.forecast, "kpi_overview": K.overview}.items():
        assert same(tables[name], mart(full)), name
    first = {r["study_id"]: r["first_enrollment_date"] for r in tables["kpi_speed_study"].collect()}
    assert first["ST1"] == dt.date(2023, 12, 4)


def test_only_touched_studies_and_keys_are_written(spark, lake):
    base, _ = lake
    store = MD.gold_store(spark, MD.Lake(spark, f"{base}/lake"), full_star(spark, base))
    of = {s: store.cells.touched(spark.createDataFrame([(s,)], "study_id string"))[0] for s in STUDIES}
    want = {s: 2 if b == of["ST1"] else 1 for s, b in of.items()}  # two of the four share a bucket
    assert list(want.values()).count(1) >= 2
    for name, t in {"cells": store.cells, **store.marts}.items():
        latest = t.latest()
        assert {s: latest[b] for s, b in of.items()} == want, name
    touched = store.fact.touched(spark.createDataFrame([("P001",), ("P005",), ("Q1",)], "patient_id string"))
    assert sorted(b for b, n in store.fact.latest().items() if n == 2) == touched
    assert store.publish() == {"load": 2, "buckets": [], "studies": []}  # nothing new


def test_publication_that_missed_a_load_catches_up(spark, lake):
    base, tables = lake
    lake2 = MD.Lake(spark, f"{base}/lake")
    late = MD.GoldStore(spark, f"{base}/late_gold", lake2.silver(), full_star(spark, base))
    assert late.publish()["load"] == 2
    assert same(late.tables()["kpi_speed_site_weekly"](), tables["kpi_speed_site_weekly"])


def test_retraction_moves_the_first_enrolment_back(spark):
    schema = "patient_id string, study_id string, site_id string, enrolled_date date"
    old = spark.createDataFrame([("a", "S", "X", dt.date(2024, 1, 1)), ("b", "S", "X", dt.date(2024, 2, 1)), ("c", "T", "X", None)], schema)
    new = spark.createDataFrame([("b", "S", "X", dt.date(2024, 2, 1)), ("c", "T", "X", None)], schema)

    def cells(df):
        zero = [f"CAST(0 AS BIGINT) AS {c}" for c in CE.STATES if c not in ("leads", "enrolled")]
        df = df.selectExpr("study_id", "site_id", "CAST(NULL AS STRING) AS race_ethnicity", "'Male' AS sex", "enrolled_date", "1L AS leads", "CAST(enrolled_date IS NOT NULL AS BIGINT) AS enrolled", *zero)
        return df.groupBy(*CE.DIMS).sum(*CE.STATES).toDF(*CE.DIMS, *CE.STATES)

    import unittest.mock as mock

    with mock.patch.object(CE, "cells", cells):
        change = CE.changes(old, new)
    assert [(r["study_id"], r["leads"], r["enrolled"]) for r in change.collect()] == [("S", -1, -1)]
    after = CE.added(cells(old), change).groupBy("study_id").agg(CE.first_enrolled().alias("first")).collect()
    assert {r["study_id"]: r["first"] for r in after} == {"S": dt.date(2024, 2, 1), "T": None}


def scanned(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


CONTEXTS = [([], None), (["study_id"], None), (["site_id"], {"study_id": ["ST1", "ST2"]}), (["site_type"], {"phase": ["Phase I"]}), (["race_ethnicity", "sex"], {"region": ["West"]})]


@pytest.mark.parametrize("context", CONTEXTS)
def test_measures_from_the_rollup_equal_the_fact(spark, lake, context):
    base, tables = lake
    full = full_star(spark, base)
    group_by, filters = context
    for name in ("x01_avg_days_to_first_patient", "x02_avg_lead_to_enrolled_days", "x03_enrolled_recent", "x04_weekly_velocity", "x05_enrolled_to_date", "x07_screen_fail_rate",
                 "x10_pct_decentralized", "x11_pct_underrepresented"):
        got = X.measure(name)(tables, group_by, filters)
        assert same(got, X.measure(name)(full, group_by, filters)), (name, context)
        plan = scanned(got)
        assert "/gold/rollup" in plan and "fact_patient_enrollment" not in plan, (name, context)


def test_the_smallest_level_answers(spark, lake):
    _, tables = lake
    r = tables["rollup"]
    assert r.choose([]) == r.choose(["study_id"]) == "study" and r.choose(["sex"]) == "study_race" and r.choose(["site_id"]) == "study_site"
    assert r.choose(["site_id", "sex", "enrolled_date"]) == "cell" and r.choose(["age"]) is None
    assert sum(r.sizes.values()) == r._read().count() and r.sizes["study"] == 4
    plan = scanned(X.measure("x05_enrolled_to_date")(tables, ["study_id"]))
    assert "PartitionFilters: [isnotnull(level" in plan
    by_age = X.measure("x05_enrolled_to_date")(tables, ["age"])
    assert "/gold/fact_patient_enrollment" in scanned(by_age) and by_age.count() == 8


def test_violating_load_leaves_the_old_gold(spark, tmp_path):
    base = str(tmp_path)
    land(base, 1, {"studies": ["ST1,PR,Sp,Onc,Phase I,50,400,2024-01-01"], "sites": ["X0,Site,fixed,West,CA,2024-01-01,PI"], "patients": ["P1,ST1,X0,30,Male,White,true", "P2,ST1,X0,30,Male,White,true"],
                   "funnel_events": [*events("P1", "ST1", "X0", 5, 1), *events("P2", "ST1", "X0", 3, 1)]})
    tables = MD.run(spark, f"{base}/landing", f"{base}/lake", "b1")
    assert {r["check"]: r["violations"] for r in tables["checks"].collect() if r["violations"]} == {}
    before = {n: sorted(map(str, tables[n].collect())) for n in ("fact_patient_enrollment", "kpi_overview", "kpi_predictability_conversion", "kpi_predictability_forecast")}
    # an enrolment without consent, at a site that no dimension has
    land(base, 2, {"patients": ["P3,ST1,X9,30,Male,White,true"], "funnel_events": ["P3,ST1,X9,lead,2024-01-01", "P3,ST1,X9,enrolled,2024-01-09"]})
    with pytest.raises(MD.PublicationError, match="fact_site_fk: 1, enrolled_implies_consent: 1"):
        MD.run(spark, f"{base}/landing", f"{base}/lake", "b2")
    now = MD.published(spark, f"{base}/lake")
    assert {n: sorted(map(str, now[n].collect())) for n in before} == before
    # the site arrives, and an earlier consent: the next run publishes both loads
    land(base, 3, {"sites": ["X9,Site,fixed,West,CA,2024-01-01,PI"], "funnel_events": ["P3,ST1,X9,consented,2024-01-02"]})
    now = MD.run(spark, f"{base}/landing", f"{base}/lake", "b3")
    assert now["fact_patient_enrollment"].count() == 3 and now["kpi_predictability_conversion"].first()["enrolled"] == 2
    assert same(now["fact_patient_enrollment"], full_star(spark, base)["fact_patient_enrollment"])


def test_a_second_row_of_a_key_is_observed(spark, tmp_path):
    from cohortflow.plans.observed import Checks, PublicationError

    base = str(tmp_path)
    land(base, 1, {"studies": ["ST1,PR,Sp,Onc,Phase I,50,400,2024-01-01"], "sites": ["X0,Site,fixed,West,CA,2024-01-01,PI"], "patients": ["P1,ST1,X0,30,Male,White,true"],
                   "funnel_events": events("P1", "ST1", "X0", 5, 1)})
    MD.run(spark, f"{base}/landing", f"{base}/lake", "b1")
    star = full_star(spark, base)
    store = MD.gold_store(spark, MD.Lake(spark, f"{base}/lake"), star)
    twice = star["fact_patient_enrollment"].unionByName(star["fact_patient_enrollment"])
    checks = Checks()
    store.fact.replace(store.fact.touched(twice), twice, 2, checks.fact(star["dim_study"], star["dim_site"]))
    with pytest.raises(PublicationError, match="fact_key_unique: 1"):
        checks.stop_at_violations()
