"""Dashboard queries B-01 … B-06 and the study slicer P-11.

The reference dashboard pulls whole Gold tables into pandas and filters there; here each
panel is a small aggregate computed in Spark and only the panel's rows leave the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from . import kpi as K


def pick_studies(df: DataFrame, picked: Sequence[str] | DataFrame | None) -> DataFrame:
    """P-11: slicer on study ids: a literal list becomes ``isin`` (pushed to the scan); a frame
    of picked ids becomes a semi join (broadcast when small, decided by AQE)."""
    if picked is None:
        return df
    if isinstance(picked, DataFrame):
        return df.join(picked.select("study_id").distinct(), "study_id", "left_semi")
    return df.filter(F.col("study_id").isin(list(picked)))


def _mart(star: dict, name: str, build):
    """A published mart when the star carries it (serving from Gold tables), else computed."""
    return star[name] if name in star else build()


def header_cards(star: dict, picked=None, params: C.Params = C.DEFAULT) -> DataFrame:
    """B-01: studies, enrolled, on-track count and mean cost per enrolled over the picked studies."""
    ov = pick_studies(_mart(star, "kpi_overview", lambda: K.overview(star, params)), picked)
    return ov.agg(
        F.count(F.lit(1)).alias("studies"),
        F.coalesce(F.sum("enrolled_to_date"), F.lit(0)).cast("bigint").alias("enrolled_to_date"),
        F.coalesce(F.sum(F.col("on_track").cast("int")), F.lit(0)).cast("bigint").alias("on_track"),
        F.avg("cost_per_enrolled_usd").alias("avg_cost_per_enrolled_usd"),
    )


def weekly_trend(star: dict, picked=None) -> DataFrame:
    """B-02: enrolments per week over the picked studies."""
    wk = pick_studies(_mart(star, "kpi_speed_site_weekly", lambda: K.speed_site_weekly(star)), picked)
    return wk.groupBy("week_start").agg(F.sum("enrolled_in_week").cast("bigint").alias("enrolled_in_week"))


def enrolled_by_race(star: dict, picked=None) -> DataFrame:
    """B-03."""
    d = pick_studies(_mart(star, "kpi_accessibility_diversity", lambda: K.diversity(star)), picked)
    return d.groupBy("race_ethnicity").agg(F.sum("enrolled").cast("bigint").alias("enrolled"))


def enrolled_by_site_type(star: dict) -> DataFrame:
    """B-04 (the reference ignores the study slicer here)."""
    return _mart(star, "kpi_accessibility_reach", lambda: K.reach(star)).groupBy("site_type").agg(F.sum("enrolled").cast("bigint").alias("enrolled"))


def forecast_table(star: dict, picked=None, params: C.Params = C.DEFAULT) -> DataFrame:
    """B-05: forecast table and enrolled-vs-target."""
    fc = pick_studies(_mart(star, "kpi_predictability_forecast", lambda: K.forecast(star, params)), picked)
    return fc.select("study_id", "enrolled_to_date", "target_enrollment", "pct_to_target", "weekly_velocity",
                     "projected_completion_date", "planned_end_date", "status")


def study_panels(star: dict, picked=None, params: C.Params = C.DEFAULT) -> DataFrame:
    """B-06: per-study speed, screen-fail and decentralized-share panels."""
    sp = pick_studies(_mart(star, "kpi_speed_study", lambda: K.speed_study(star)), picked).select(
        "study_id", "therapeutic_area", "days_to_first_patient", "avg_days_lead_to_enrolled")
    cv = _mart(star, "kpi_predictability_conversion", lambda: K.conversion(star)).select("study_id", "screen_fail_rate_pct")
    dc = (_mart(star, "kpi_overview", lambda: K.overview(star, params)).select("study_id", "pct_decentralized_enrolled")
          if "kpi_overview" in star else K.decentralized_share(star))
    return sp.join(cv, "study_id", "left").join(dc, "study_id", "left")
