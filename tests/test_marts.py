"""Mart, measure, quality and governance semantics on hand-made stars."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.functions.calendar import date_dim
from cohortflow.operators import governance as GV
from cohortflow.plans import kpi as K
from cohortflow.plans import measures as X
from cohortflow.plans import quality as Q

D = dt.date
FACT_SCHEMA = ("patient_id string, study_id string, site_id string, lead_date date, pre_screened_date date, "
               "consented_date date, screened_date date, randomized_date date, enrolled_date date, completed_date date, "
               "age int, sex string, race_ethnicity string, is_rural boolean, screen_failed boolean, is_enrolled boolean, "
               "is_completed boolean, days_lead_to_enrolled bigint, days_screened_to_randomized bigint, "
               "days_consent_to_enrolled bigint")
STUDY_SCHEMA = ("study_id string, protocol_number string, sponsor string, therapeutic_area string, phase string, "
                "target_enrollment int, planned_duration_days int, start_date date, planned_end_date date")


def fact_row(pid, study, site, enrolled=None, race="White", consented=None, screened=None, randomized=None):
    lead = D(2026, 1, 1)
    return (pid, study, site, lead, None, consented, screened, randomized, enrolled, None, 40, "Female", race, False,
            screened is not None and randomized is None, enrolled is not None, False,
            (enrolled - lead).days if enrolled else None,
            (randomized - screened).days if randomized and screened else None,
            (enrolled - consented).days if enrolled and consented else None)


def make_star(spark, facts, studies):
    sites = spark.createDataFrame([("X1", "community", "R", True), ("X2", "fixed", "R", False)],
                                  "site_id string, site_type string, region string, is_decentralized boolean")
    return {
        "fact_patient_enrollment": spark.createDataFrame(facts, FACT_SCHEMA),
        "dim_study": spark.createDataFrame(studies, STUDY_SCHEMA),
        "dim_site": sites,
        "fact_marketing_daily": spark.createDataFrame([("S1", 100.10), ("S1", 0.2)], "study_id string, spend_usd double"),
        "fact_site_financials": spark.createDataFrame([("S1", 1000.0)], "study_id string, operating_cost_usd double"),
    }


def study(sid, target, start=D(2025, 1, 1), end=D(2026, 12, 31)):
    return (sid, "P", "Sp", "Onc", "Phase I", target, (end - start).days, start, end)


def test_forecast_half_even_velocity_and_nulls(spark):
    as_of = D(2026, 5, 1)
    # one enrolment in the last 8 weeks -> 1/8 = 0.125 -> half-even 0.12 (half-up would give 0.13)
    facts = [fact_row("p1", "S1", "X1", enrolled=D(2026, 4, 20))]
    studies = [study("S1", 10), study("S2", 5)]  # S2 has no enrolments
    star = make_star(spark, facts, studies)
    fc = K.forecast(star, C.Params(as_of=as_of, velocity_weeks=8))
    r = {x["study_id"]: x for x in fc.collect()}
    assert r["S1"]["weekly_velocity"] == 0.12
    assert r["S1"]["enrolled_to_date"] == 1 and r["S1"]["remaining"] == 9
    # 9 / 0.12 weeks = 75 weeks = 525 days
    assert r["S1"]["projected_completion_date"] == as_of + dt.timedelta(days=525)
    assert r["S1"]["on_track"] is False and r["S1"]["status"] == C.STATUS_AT_RISK
    assert r["S1"]["pct_to_target"] == 10.0
    # no enrolments: 0 enrolled (not NULL), no velocity -> NULL projection, not on track
    assert r["S2"]["enrolled_to_date"] == 0 and r["S2"]["remaining"] == 5
    assert r["S2"]["projected_completion_date"] is None and r["S2"]["on_track"] is False
    assert r["S2"]["weekly_velocity"] == 0.0


def test_forecast_window_is_inclusive_at_start(spark):
    as_of = D(2026, 5, 1)
    start = as_of - dt.timedelta(days=56)
    facts = [fact_row("p1", "S1", "X1", enrolled=start), fact_row("p2", "S1", "X1", enrolled=start - dt.timedelta(days=1))]
    star = make_star(spark, facts, [study("S1", 2)])
    r = K.forecast(star, C.Params(as_of=as_of, velocity_weeks=8)).first()
    assert r["weekly_velocity"] == 0.12  # 1 of 2 inside, 1/8 -> 0.12
    # measure X-03 uses the exclusive start (DATESINPERIOD ending at as_of)
    m = X.enrolled_recent(star, ["study_id"], None, C.Params(as_of=as_of, velocity_weeks=8)).first()
    assert m["enrolled_recent"] == 0


def test_measures_null_race_and_division(spark):
    facts = [fact_row("p1", "S1", "X1", enrolled=D(2026, 1, 5), race=None),
             fact_row("p2", "S1", "X2", enrolled=D(2026, 1, 6), race="White"),
             fact_row("p3", "S1", "X2")]
    star = make_star(spark, facts, [study("S1", 4)])
    assert X.pct_underrepresented(star).first()["pct_underrepresented"] == 0.5
    assert X.pct_decentralized(star).first()["pct_decentralized"] == 0.5
    assert X.pct_to_target(star).first()["pct_to_target"] == 0.5
    assert X.screen_fail_rate(star).first()["screen_fail_rate"] is None  # nobody screened: DIVIDE -> blank
    r = X.cost_per_enrolled(star).first()
    assert r["cost_per_enrolled"] == pytest.approx((100.30 + 1000.0) / 2)
    total = X.cost_per_enrolled(star, []).first()
    assert total["cost_per_enrolled"] == pytest.approx((100.30 + 1000.0) / 2)


def test_quality_checks_flag_violations(spark):
    bad = fact_row("p1", "S9", "X9", enrolled=D(2026, 1, 5))  # orphan study and site, enrolled without consent
    dup = fact_row("p1", "S9", "X9")
    star = make_star(spark, [bad, dup], [study("S1", 4)])
    fk = {r["check"]: r["violations"] for r in Q.referential_integrity(star).collect()}
    assert fk == {"fact_study_fk": 2, "fact_site_fk": 2}
    assert Q.fact_key(star).filter("check = 'fact_key_unique'").first()["violations"] == 1
    assert Q.funnel_monotonic(star).first()["violations"] == 1
    assert Q.funnel_monotonic(star).first()["passed"] is False


def test_governance_filter_then_mask(spark):
    df = spark.createDataFrame([("PT-1", "X1"), ("PT-2", "X2")], "patient_id string, site_id string")
    memberships = spark.createDataFrame([("admin", GV.ALL_SITES), ("admin", GV.PHI_READERS)], "user string, `group` string")
    grants = spark.createDataFrame([("coord", "X1")], "user string, site_id string")
    coord = GV.resolve("coord", memberships, grants)
    out = GV.secured(df, coord, ["patient_id", "site_id"])
    # the filter saw the raw site before it was masked
    assert [tuple(r) for r in out.collect()] == [(C.REDACTED, C.REDACTED)]
    admin = GV.resolve("admin", memberships, grants)
    assert GV.secured(df, admin, ["patient_id"]).count() == 2
    assert GV.secured(df, admin, ["patient_id"]).filter(F.col("patient_id") == "PT-1").count() == 1


def test_forecast_without_or_with_zero_target(spark):
    as_of = D(2026, 6, 30)
    star = make_star(spark, [fact_row("p1", "S1", "X1", enrolled=D(2026, 6, 20)), fact_row("p2", "S2", "X1", enrolled=D(2026, 6, 20))],
                     [study("S1", None), study("S2", 0)])
    r = {x["study_id"]: x for x in K.forecast(star, C.Params(as_of=as_of)).collect()}
    assert r["S1"]["remaining"] is None and r["S1"]["projected_completion_date"] is None and r["S1"]["on_track"] is False
    assert r["S2"]["pct_to_target"] is None and r["S2"]["remaining"] == 0


def test_filters_must_name_a_column_and_reach_site_cost(spark):
    star = make_star(spark, [fact_row("p1", "S1", "X1", enrolled=D(2026, 6, 20))], [study("S1", 4)])
    with pytest.raises(ValueError, match="no table has"):
        X.enrolled_to_date(star, ["study_id"], {"regoin": ["West"]}).collect()
    star["fact_site_financials"] = spark.createDataFrame([("S1", "X1", 1000.0)], "study_id string, site_id string, operating_cost_usd double")
    by_region = X.total_site_cost(star, ["region"]).collect()
    assert len(by_region) == 1 and by_region[0]["total_site_cost"] is not None
    assert X.total_site_cost(star, [], {"region": ["nowhere"]}).first()["total_site_cost"] is None
    with pytest.raises(ValueError, match="no relationship"):
        X.studies_on_track(star, ["site_type"])


def test_calendar(spark):
    d = date_dim(spark, C.CALENDAR_START, C.CALENDAR_END)
    assert d.count() == 1096
    r = d.filter(F.col("date_key") == D(2024, 1, 3)).first()
    assert (r["year"], r["month"], r["day"], r["week"], r["day_name"]) == (2024, 1, 3, 1, "Wednesday")
