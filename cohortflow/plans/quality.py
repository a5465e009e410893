"""Data-quality checks Q-01 … Q-08: each returns rows ``(check, violations, passed)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators.aggregates import count_if
from . import kpi as K

CORE = ["dim_study", "dim_site", "dim_patient", "fact_patient_enrollment", "kpi_overview", "kpi_predictability_forecast"]
FORECAST_FIELDS = ["projected_completion_date", "on_track", "weekly_velocity", "pct_to_target"]


def _row(df: DataFrame, name: str, violations: Column) -> DataFrame:
    v = df.agg(violations.cast("bigint").alias("violations"))
    return v.select(F.lit(name).alias("check"), "violations", (F.col("violations") == 0).alias("passed"))


def _tables(star: dict, params: C.Params) -> dict:
    t = {n: star[n] for n in CORE if n in star}
    t["kpi_overview"] = K.overview(star, params)
    t["kpi_predictability_forecast"] = K.forecast(star, params)
    return t


def nonempty(star: dict, params: C.Params = C.DEFAULT) -> DataFrame:
    """Q-01: core tables are not empty."""
    t = _tables(star, params)
    parts = [_row(t[n], f"nonempty:{n}", F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)) for n in CORE]
    return reduce(DataFrame.unionByName, parts)


def fact_key(star: dict) -> DataFrame:
    """Q-02: (patient, study) unique and not NULL."""
    f = star["fact_patient_enrollment"]
    dup = f.groupBy("patient_id", "study_id").count().filter("count > 1")
    a = _row(dup, "fact_key_unique", F.count(F.lit(1)))
    b = _row(f, "fact_key_not_null", count_if(F.col("patient_id").isNull() | F.col("study_id").isNull()))
    return a.unionByName(b)


def referential_integrity(star: dict) -> DataFrame:
    """Q-03: every fact study and site exists in its dimension (anti joins)."""
    f = star["fact_patient_enrollment"]
    o1 = f.join(star["dim_study"], "study_id", "left_anti")
    o2 = f.join(star["dim_site"], "site_id", "left_anti")
    return _row(o1, "fact_study_fk", F.count(F.lit(1))).unionByName(_row(o2, "fact_site_fk", F.count(F.lit(1))))


def funnel_monotonic(star: dict) -> DataFrame:
    """Q-04: enrolled implies consented, and consent is not after enrolment."""
    f = star["fact_patient_enrollment"].filter("is_enrolled")
    bad = F.col("consented_date").isNull() | (F.col("enrolled_date") < F.col("consented_date"))
    return _row(f, "enrolled_implies_consent", count_if(bad))


def screen_fail_range(star: dict) -> DataFrame:
    """Q-05: screen-fail rate within [0, 100]; NULL rates are reported apart."""
    c = K.conversion(star)
    r = F.col("screen_fail_rate_pct")
    a = _row(c, "screen_fail_rate_in_range", count_if(r.isNotNull() & ~r.between(0, 100)))
    b = _row(c, "screen_fail_rate_null", count_if(r.isNull()))
    return a.unionByName(b)


def diversity_sums(star: dict) -> DataFrame:
    """Q-06: diversity shares add up to 95–105 per study (studies without enrolments: n/a)."""
    d = K.diversity(star).groupBy("study_id").agg(F.sum("pct_of_study_enrolled").alias("s"))
    d = d.filter(F.col("s").isNotNull())
    return _row(d, "diversity_sums_to_100", count_if(~F.col("s").between(95, 105)))


def forecast_fields(star: dict, params: C.Params = C.DEFAULT) -> DataFrame:
    """Q-07: forecast has its columns and a boolean, non-NULL ``on_track``."""
    fc = K.forecast(star, params)
    missing = [c for c in FORECAST_FIELDS if c not in fc.columns]
    bool_ok = dict(fc.dtypes).get("on_track") == "boolean"
    penalty = len(missing) + (0 if bool_ok else 1)
    return _row(fc, "forecast_fields", count_if(F.col("on_track").isNull()) + F.lit(penalty))


def decentralized_range(star: dict, params: C.Params = C.DEFAULT) -> DataFrame:
    """Q-08: decentralized share within [0, 100] where present."""
    o = K.overview(star, params)
    r = F.col("pct_decentralized_enrolled")
    return _row(o, "decentralized_share_in_range", count_if(r.isNotNull() & ~r.between(0, 100)))


def all_checks(star: dict, params: C.Params = C.DEFAULT) -> DataFrame:
    parts = [nonempty(star, params), fact_key(star), referential_integrity(star), funnel_monotonic(star),
             screen_fail_range(star), diversity_sums(star), forecast_fields(star, params),
             decentralized_range(star, params)]
    return reduce(DataFrame.unionByName, parts)
