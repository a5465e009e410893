"""Mission KPI marts K-01 … K-09.

Every mart aggregates the fact first and joins dimensions to the aggregate (one row per
study or site), so no join ever sees raw fact rows except the bounded site lookup, and every
window runs over aggregated rows. What they aggregate are the additive states of ``cells.states_of``:
the fact's rows, or the kept-up cells of a published star, with equal results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import (date_lit, days_between, pct, round_half_even, safe_div, trunc_int, week_start,
                                zero_floor)
from ..operators.aggregates import share_of_partition, sum_by
from .cells import first_enrolled, states_of, total
from .gold import bounded


def speed_study(star: dict) -> DataFrame:
    """K-01: first enrolment, days to first patient, enrolled, average cycle times per study."""
    agg = states_of(star).groupBy("study_id").agg(
        first_enrolled().alias("first_enrollment_date"),
        total("enrolled").alias("enrolled_to_date"),
        F.round(safe_div(F.sum("lead_days"), F.sum("lead_days_n")), 1).alias("avg_days_lead_to_enrolled"),
        F.round(safe_div(F.sum("screen_days"), F.sum("screen_days_n")), 1).alias("avg_days_screened_to_randomized"),
    )
    s = star["dim_study"].select("study_id", "therapeutic_area", "phase", "start_date")
    j = s.join(agg, "study_id", "left")
    return j.select(
        "study_id", "therapeutic_area", "phase", "first_enrollment_date",
        days_between("start_date", "first_enrollment_date").alias("days_to_first_patient"),
        F.coalesce("enrolled_to_date", F.lit(0).cast("bigint")).alias("enrolled_to_date"),
        "avg_days_lead_to_enrolled", "avg_days_screened_to_randomized",
    )


def speed_site_weekly(star: dict) -> DataFrame:
    """K-02: enrolments per site × study × week (Monday)."""
    f = states_of(star).filter("enrolled > 0")
    return f.groupBy("site_id", "study_id", week_start("enrolled_date").alias("week_start")).agg(
        total("enrolled").alias("enrolled_in_week"))


def diversity(star: dict) -> DataFrame:
    """K-03: enrolled per study × race × sex and its share of the study (window on the aggregate)."""
    g = states_of(star).groupBy("study_id", "race_ethnicity", "sex").agg(total("enrolled").alias("enrolled"))
    return share_of_partition(g, "enrolled", ["study_id"], "pct_of_study_enrolled")


def reach(star: dict) -> DataFrame:
    """K-04: enrolled and active sites per site type × region.

    The fact is reduced to one row per site before the (bounded) site join, so the distinct
    site count is a plain count of those rows."""
    per_site = states_of(star).groupBy("site_id").agg(total("enrolled").alias("enrolled"))
    st = bounded(star["dim_site"], "site_id", "site_type", "region")
    j = per_site.join(st, "site_id")
    return j.groupBy("site_type", "region").agg(
        F.sum("enrolled").cast("bigint").alias("enrolled"), F.count(F.lit(1)).alias("sites"))


def conversion(star: dict) -> DataFrame:
    """K-05: funnel counts, pass rate, screen-fail rate and lead-to-enrolled rate per study."""
    g = states_of(star).groupBy("study_id").agg(*[total(c).alias(c) for c in ("leads", "consented", "screened", "randomized", "enrolled")])
    return g.select(
        "*",
        pct(F.col("randomized"), F.col("screened")).alias("pass_rate_pct"),
        pct(F.col("screened") - F.col("randomized"), F.col("screened")).alias("screen_fail_rate_pct"),
        pct(F.col("enrolled"), F.col("leads")).alias("lead_to_enrolled_pct"),
    )


def forecast(star: dict, params: C.Params = C.DEFAULT) -> DataFrame:
    """K-06: run-rate forecast per study (two aggregates and a join, no loop over studies).

    velocity = bround(enrolled in the last N weeks / N, 2); projected completion =
    as_of + floor(remaining / velocity × 7) days, NULL without velocity; on track when the
    projection is not after the planned end."""
    weeks = params.velocity_weeks
    as_of = date_lit(params.as_of)
    since = F.date_sub(as_of, 7 * weeks)
    agg = states_of(star).filter("enrolled > 0").groupBy("study_id").agg(
        total("enrolled").alias("_enrolled"), total("enrolled", F.col("enrolled_date") >= since).alias("_recent"))
    s = star["dim_study"]
    j = s.join(agg, "study_id", "left")
    enrolled = F.coalesce(F.col("_enrolled"), F.lit(0).cast("bigint"))
    velocity = round_half_even(F.coalesce(F.col("_recent"), F.lit(0)).cast("double") / F.lit(float(weeks)), 2)
    j = j.withColumn("enrolled_to_date", enrolled).withColumn("weekly_velocity", velocity)
    weeks_remaining = F.greatest(F.lit(0.0), F.datediff("planned_end_date", as_of).cast("double") / F.lit(7.0))
    # an unknown target leaves what remains, and so the projection, unknown
    remaining = F.when(F.col("target_enrollment").isNotNull(), zero_floor(F.col("target_enrollment") - F.col("enrolled_to_date"))).cast("int")
    j = j.withColumn("remaining", remaining)
    weeks_to_target = F.when(F.col("weekly_velocity") > 0, F.col("remaining").cast("double") / F.col("weekly_velocity"))
    j = j.withColumn("weeks_to_target", weeks_to_target)
    days = F.floor(F.round(F.col("weeks_to_target") * F.lit(7.0), 9)).cast("int")
    projected = F.when(F.col("weeks_to_target").isNotNull(), F.date_add(as_of, days))
    j = j.withColumn("projected_completion_date", projected)
    on_track = F.coalesce(F.col("projected_completion_date") <= F.col("planned_end_date"), F.lit(False))
    return j.select(
        *s.columns,
        "enrolled_to_date",
        round_half_even(safe_div(F.lit(100.0) * F.col("enrolled_to_date"), F.col("target_enrollment")), 1).alias("pct_to_target"),
        "weekly_velocity", "remaining", "weeks_to_target",
        trunc_int(F.col("enrolled_to_date") + F.col("weekly_velocity") * weeks_remaining).alias("projected_at_plan_end"),
        "projected_completion_date",
        on_track.alias("on_track"),
        F.when(on_track, C.STATUS_ON_TRACK).otherwise(C.STATUS_AT_RISK).alias("status"),
    )


def decentralized_share(star: dict) -> DataFrame:
    """K-08: percent of a study's enrolments at community or mobile sites."""
    per = states_of(star).groupBy("study_id", "site_id").agg(total("enrolled").alias("enrolled"))
    st = bounded(star["dim_site"], "site_id", "is_decentralized")
    j = per.join(st, "site_id")
    g = j.groupBy("study_id").agg(
        F.sum(F.when(F.col("is_decentralized"), F.col("enrolled")).otherwise(0)).alias("_dec"),
        F.sum("enrolled").alias("_enr"))
    return g.select("study_id", pct(F.col("_dec"), F.col("_enr")).alias("pct_decentralized_enrolled"))


def cost_per_enrolled(star: dict) -> DataFrame:
    """K-09: (site operating cost + marketing spend) / enrolled, rounded to whole dollars.

    Costs and spend are summed per study before they meet the enrolment counts (A-06)."""
    enr = states_of(star).groupBy("study_id").agg(total("enrolled").alias("_enr"))
    sc = sum_by(star["fact_site_financials"], ["study_id"], "operating_cost_usd", "_op")
    mk = sum_by(star["fact_marketing_daily"], ["study_id"], "spend_usd", "_mk")
    j = enr.join(sc, "study_id", "left").join(mk, "study_id", "left")
    cost = F.coalesce(F.col("_op"), F.lit(0.0)) + F.coalesce(F.col("_mk"), F.lit(0.0))
    return j.select("study_id", F.round(safe_div(cost, F.col("_enr")), 0).alias("cost_per_enrolled_usd"))


def overview(star: dict, params: C.Params = C.DEFAULT) -> DataFrame:
    """K-07: one row per study across speed, predictability, accessibility and cost."""
    s = star["dim_study"].select("study_id", "therapeutic_area", "phase", "target_enrollment")
    sp = speed_study(star).select("study_id", "enrolled_to_date", "days_to_first_patient")
    fc = forecast(star, params).select("study_id", "projected_completion_date", "on_track")
    return (s.join(sp, "study_id", "left").join(fc, "study_id", "left")
            .join(decentralized_share(star), "study_id", "left")
            .join(cost_per_enrolled(star), "study_id", "left"))
