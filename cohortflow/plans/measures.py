"""Semantic-layer measures X-01 … X-15: ``measure(star, group_by, filters, params) -> DataFrame``.

A measure is a value under a filter context: ``filters`` (column -> allowed values) restrict
every fact that has the column; ``group_by`` is the visual's grouping (columns of the
enrolment fact, optionally its site and study attributes). Division gives NULL on zero, like
a BI ``DIVIDE``; fractions are 0–1. Measures over different facts (spend, site cost, enrolment)
are aggregated apart and joined on the grouping, never joined row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import date_lit, days_between, safe_div
from .cells import total, with_states
from .gold import bounded
from .kpi import forecast

SITE_ATTRS = ["site_type", "region", "is_decentralized"]
STUDY_ATTRS = ["therapeutic_area", "phase"]


def _model(star: dict) -> set[str]:
    """Every column that a filter may name."""
    tables = ("fact_patient_enrollment", "dim_study", "dim_site", "fact_marketing_daily", "fact_site_financials")
    return {c for t in tables for c in star[t].columns}


def _filter(star: dict, df: DataFrame, filters: dict | None) -> DataFrame:
    """A filter on a column that this table isn't related to leaves it as it is (as in the semantic
    model); one on a column that no table has is an error."""
    unknown = sorted(set(filters or {}) - _model(star))
    if unknown:
        raise ValueError(f"no table has {unknown}")
    for c, vals in (filters or {}).items():
        if c in df.columns:
            df = df.filter(F.col(c).isin(list(vals)))
    return df


def _fact(star: dict, group_by: Sequence[str], filters: dict | None, need_site: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """Rows with the additive states: of the smallest roll-up level that holds the grouping, the filters
    and the columns ``also`` needed, else of the fact."""
    cols = set(group_by) | set(filters or {})
    f = None
    if "rollup" in star:
        own = set(star["fact_patient_enrollment"].columns)
        needed = {"site_id" if c in SITE_ATTRS else "study_id" if c in STUDY_ATTRS else c for c in cols if c in own or c in SITE_ATTRS or c in STUDY_ATTRS}
        level = star["rollup"].choose(needed | set(also) | ({"site_id"} if need_site else set()))
        f = None if level is None else star["rollup"].level(level)
    if f is None:
        f = with_states(star["fact_patient_enrollment"]).withColumn("first_enrolled", F.col("enrolled_date"))
    if need_site or cols & set(SITE_ATTRS):
        f = f.join(bounded(star["dim_site"], "site_id", *SITE_ATTRS), "site_id", "left")
    if cols & set(STUDY_ATTRS):
        f = f.join(bounded(star["dim_study"], "study_id", *STUDY_ATTRS), "study_id", "left")
    return _filter(star, f, filters)


def _agg(df: DataFrame, group_by: Sequence[str], *cols: Column) -> DataFrame:
    return df.groupBy(*group_by).agg(*cols) if group_by else df.agg(*cols)


def enrolled_to_date(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-05."""
    return _agg(_fact(star, group_by, filters), group_by, total("enrolled").alias("enrolled_to_date"))


def avg_days_to_first_patient(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-01: mean over the studies in context of (first enrolment − study start)."""
    g = list(group_by)
    per = g + ([] if "study_id" in g else ["study_id"])
    f = _fact(star, group_by, filters, also=["study_id"])
    first = f.groupBy(*per).agg(F.min("first_enrolled").alias("_first"))
    s = bounded(star["dim_study"], "study_id", "start_date")
    d = first.join(s, "study_id").withColumn("_days", days_between("start_date", "_first"))
    return _agg(d, g, F.avg("_days").alias("avg_days_to_first_patient"))


def avg_lead_to_enrolled_days(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-02."""
    return _agg(_fact(star, group_by, filters), group_by, safe_div(F.sum("lead_days"), F.sum("lead_days_n")).alias("avg_lead_to_enrolled_days"))


def _recent(params: C.Params) -> Column:
    end = date_lit(params.as_of)
    start = F.date_sub(end, 7 * params.velocity_weeks)
    return (F.col("enrolled_date") > start) & (F.col("enrolled_date") <= end)


def enrolled_recent(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-03: enrolments in the window of N weeks ending at the context's last date (inclusive)."""
    return _agg(_fact(star, group_by, filters, also=["enrolled_date"]), group_by, total("enrolled", _recent(params)).alias("enrolled_recent"))


def weekly_velocity(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-04: X-03 / N."""
    return _agg(_fact(star, group_by, filters, also=["enrolled_date"]), group_by,
                (total("enrolled", _recent(params)).cast("double") / F.lit(float(params.velocity_weeks))).alias("weekly_velocity"))


def pct_to_target(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-06: enrolled / sum of targets of the studies in context (aggregated apart, then joined)."""
    g = list(group_by)
    enr = enrolled_to_date(star, g, filters, params)
    studies = _filter(star, star["dim_study"], filters)
    if g and set(g) <= {"study_id", *STUDY_ATTRS}:
        tgt = studies.groupBy(*g).agg(F.sum("target_enrollment").alias("_target"))
        j = enr.join(tgt, g, "left")
    elif not g:
        j = _joined([enr, studies.agg(F.sum("target_enrollment").alias("_target"))], g)
    else:
        # the study targets are not filtered by a non-study grouping: one total for every group
        j = enr.withColumn("_target", studies.agg(F.sum("target_enrollment")).scalar())
    return j.select(*g, safe_div(F.col("enrolled_to_date"), F.col("_target")).alias("pct_to_target"))


def screen_fail_rate(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-07: (screened − randomized) / screened."""
    scr, rnd = total("screened"), total("randomized")
    return _agg(_fact(star, group_by, filters), group_by, safe_div(scr - rnd, scr).alias("screen_fail_rate"))


def _forecast_ctx(star, group_by, filters, params):
    fc = forecast(star, params)
    bad = [c for c in group_by if c not in fc.columns]
    if bad:
        raise ValueError(f"the forecast has no relationship to {bad}")
    return _filter(star, fc, filters)


def studies_on_track(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-08: distinct studies whose forecast is on track."""
    fc = _forecast_ctx(star, group_by, filters, params)
    return _agg(fc, group_by, F.count_distinct(F.when(F.col("on_track"), F.col("study_id"))).alias("studies_on_track"))


def studies_at_risk(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-09: distinct studies whose forecast is not on track."""
    fc = _forecast_ctx(star, group_by, filters, params)
    return _agg(fc, group_by, F.count_distinct(F.when(~F.col("on_track"), F.col("study_id"))).alias("studies_at_risk"))


def pct_decentralized(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-10: enrolled at community/mobile sites / enrolled."""
    f = _fact(star, group_by, filters, need_site=True)
    return _agg(f, group_by, safe_div(total("enrolled", F.col("is_decentralized")), total("enrolled")).alias("pct_decentralized"))


def pct_underrepresented(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-11: enrolled whose race is not the majority value / enrolled (a NULL race counts as not)."""
    f = _fact(star, group_by, filters, also=["race_ethnicity"])
    under = total("enrolled", ~F.coalesce(F.col("race_ethnicity") == C.MAJORITY_RACE, F.lit(False)))
    return _agg(f, group_by, safe_div(under, total("enrolled")).alias("pct_underrepresented"))


def _money(star, table, col, out, group_by, filters):
    g = [c for c in group_by]
    at_sites = "site_id" in star[table].columns
    bad = [c for c in g if c not in star[table].columns and c not in STUDY_ATTRS and not (at_sites and c in SITE_ATTRS)]
    if bad:
        raise ValueError(f"{table} has no relationship to {bad}")
    df = star[table]
    if at_sites and (set(g) | set(filters or {})) & set(SITE_ATTRS):
        df = df.join(bounded(star["dim_site"], "site_id", *SITE_ATTRS), "site_id", "left")
    if set(g) & set(STUDY_ATTRS) or set(filters or {}) & set(STUDY_ATTRS):
        df = df.join(bounded(star["dim_study"], "study_id", *STUDY_ATTRS), "study_id", "left")
    df = _filter(star, df, filters)
    return _agg(df, g, F.sum(F.col(col).cast("decimal(18,2)")).cast("double").alias(out))


def total_marketing_spend(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-12."""
    return _money(star, "fact_marketing_daily", "spend_usd", "total_marketing_spend", group_by, filters)


def total_site_cost(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-13."""
    return _money(star, "fact_site_financials", "operating_cost_usd", "total_site_cost", group_by, filters)


def _joined(frames: list[DataFrame], group_by: Sequence[str]) -> DataFrame:
    """Combine per-group aggregates of different facts: full outer join on the grouping, or
    for the grand total (one row each) a union folded by ``max`` (no keyless join)."""
    out = frames[0]
    if group_by:
        for f in frames[1:]:
            out = out.join(f, list(group_by), "full_outer")
        return out
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    names = [c for fr in frames for c in fr.columns]
    return out.agg(*[F.max(c).alias(c) for c in dict.fromkeys(names)])


def cost_per_enrolled(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-14: (spend + site cost) / enrolled; three facts aggregated apart, then joined."""
    g = list(group_by)
    j = _joined([total_marketing_spend(star, g, filters), total_site_cost(star, g, filters),
                 enrolled_to_date(star, g, filters)], g)
    both_blank = F.col("total_marketing_spend").isNull() & F.col("total_site_cost").isNull()
    total = F.when(~both_blank, F.coalesce("total_marketing_spend", F.lit(0.0)) + F.coalesce("total_site_cost", F.lit(0.0)))
    return j.select(*g, safe_div(total, F.col("enrolled_to_date")).alias("cost_per_enrolled"))


def acquisition_cost_per_enrolled(star, group_by=("study_id",), filters=None, params=C.DEFAULT) -> DataFrame:
    """X-15: spend / enrolled."""
    g = list(group_by)
    j = _joined([total_marketing_spend(star, g, filters), enrolled_to_date(star, g, filters)], g)
    return j.select(*g, safe_div(F.col("total_marketing_spend"), F.col("enrolled_to_date")).alias(
        "acquisition_cost_per_enrolled"))


MEASURES = {
    "x01_avg_days_to_first_patient": avg_days_to_first_patient,
    "x02_avg_lead_to_enrolled_days": avg_lead_to_enrolled_days,
    "x03_enrolled_recent": enrolled_recent,
    "x04_weekly_velocity": weekly_velocity,
    "x05_enrolled_to_date": enrolled_to_date,
    "x06_pct_to_target": pct_to_target,
    "x07_screen_fail_rate": screen_fail_rate,
    "x08_studies_on_track": studies_on_track,
    "x09_studies_at_risk": studies_at_risk,
    "x10_pct_decentralized": pct_decentralized,
    "x11_pct_underrepresented": pct_underrepresented,
    "x12_total_marketing_spend": total_marketing_spend,
    "x13_total_site_cost": total_site_cost,
    "x14_cost_per_enrolled": cost_per_enrolled,
    "x15_acquisition_cost_per_enrolled": acquisition_cost_per_enrolled,
}


def measure(name: str):
    """``measure(name)(star, group_by, filters, params) -> DataFrame``."""
    return MEASURES[name]
