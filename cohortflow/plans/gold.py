"""Gold star schema: D-01 … D-08.

Only the study, site and campaign dimensions get a broadcast hint, and only after a bounded
size probe proves them small (``bounded``). Every other join is left to AQE, which broadcasts
at runtime only when the measured side is small.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.calendar import date_dim
from ..functions.scalar import days_between
from ..operators.pivot import milestone_pivot, representative

FACT_KEY = ["patient_id", "study_id"]


def fact_patient_enrollment(funnel: DataFrame, dim_patient: DataFrame) -> DataFrame:
    """D-06: one row per patient × study with the first date of each stage, flags, cycle times.

    A single aggregate (partial + final) pivots the long events; the site is the site of
    the earliest event (then the smallest id) instead of an arbitrary ``any_value``."""
    ev = milestone_pivot(funnel, FACT_KEY, "stage", C.FUNNEL_STAGES, "event_date",
                         carry={"site_id": representative("site_id", ["event_date"])})
    p = dim_patient.select("patient_id", "study_id", "age", "sex", "race_ethnicity", "is_rural")
    f = ev.join(p, FACT_KEY)
    return f.select(
        "patient_id", "study_id", "site_id",
        *[f"{s}_date" for s in C.FUNNEL_STAGES],
        "age", "sex", "race_ethnicity", "is_rural",
        (F.col("screened_date").isNotNull() & F.col("randomized_date").isNull()).alias("screen_failed"),
        F.col("enrolled_date").isNotNull().alias("is_enrolled"),
        F.col("completed_date").isNotNull().alias("is_completed"),
        days_between("lead_date", "enrolled_date").alias("days_lead_to_enrolled"),
        days_between("screened_date", "randomized_date").alias("days_screened_to_randomized"),
        days_between("consented_date", "enrolled_date").alias("days_consent_to_enrolled"),
    )


class Lazy(dict):
    """A dict of DataFrames built on first access (a query only plans the tables it reads)."""

    def __init__(self, builders: dict):
        super().__init__()
        self._builders = builders
        self._lock = threading.RLock()

    def __missing__(self, name):
        with self._lock:
            if dict.__contains__(self, name):
                return dict.__getitem__(self, name)
            df = self._builders[name]()
            self[name] = df
            return df

    def __contains__(self, name):
        return name in self._builders

    def keys(self):
        return self._builders.keys()

    def copy(self):
        out = Lazy(self._builders)
        out.update(dict(self.items()))
        return out


def build_star(spark: SparkSession, silver: dict, dim_patient, params: C.Params,
               funnel_events: str = "funnel") -> Lazy:
    """Gold tables (lazy). ``dim_patient`` may be a DataFrame or a zero-argument builder;
    ``funnel_events`` names the Silver entry the fact pivots (``first_per_key`` leaves every
    per-stage minimum unchanged, so raw Bronze events give the same fact)."""
    dp = dim_patient if callable(dim_patient) else (lambda: dim_patient)
    return Lazy({
        "dim_study": lambda: silver["study"],                    # D-01
        "dim_site": lambda: silver["site"],                      # D-02
        "dim_patient": dp,                                       # D-03
        "dim_campaign": lambda: silver["campaign"],              # D-04
        "dim_date": lambda: date_dim(spark, params.calendar_start, params.calendar_end),  # D-05
        "fact_patient_enrollment": lambda: fact_patient_enrollment(silver[funnel_events], dp()),  # D-06
        "fact_marketing_daily": lambda: silver["marketing"],     # D-07
        "fact_site_financials": lambda: silver["site_costs"],    # D-08
        "study_budgets": lambda: silver["budget"],
    })


BROADCAST_MAX_ROWS = 200_000
_checked: dict = {}
_checked_lock = threading.Lock()


def bounded(dim: DataFrame, *cols: str, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Checked broadcast for a dimension (one row per study, site or campaign).

    The size is proven, not assumed: a bounded probe (``limit(max_rows + 1).count()``, which
    stops reading after ``max_rows + 1`` rows) runs once per DataFrame; within the bound the
    side gets a broadcast hint, beyond it no hint is given and AQE chooses a shuffle join (and
    still broadcasts at runtime if the measured side turns out small). ``cols`` projects the
    dimension after the (cached) check, so every caller of one dimension shares one probe."""
    key = id(dim)
    with _checked_lock:
        hit = _checked.get(key)
    if hit is None or hit[0] is not dim:
        small = dim.limit(max_rows + 1).count() <= max_rows
        with _checked_lock:
            _checked[key] = (dim, small)
    else:
        small = hit[1]
    out = dim.select(*cols) if cols else dim
    return F.broadcast(out) if small else out
