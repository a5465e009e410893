"""Q-01 … Q-08 as metrics of the writes that publish Gold.

Each check is a ``DataFrame.observe`` metric on rows that are being written anyway: no check scans the
fact again. What an aggregate of a stream of rows can't say, a column says beforehand: a row of a key
that was there already, a missing dimension, a study's sum of shares. The publication reads the metrics
after each write and stops at the first violation, before its load counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .gold import FACT_KEY, bounded
from .quality import FORECAST_FIELDS

#: Reported, and no reason to stop: a study without screened patients has no rate.
TOLD_ONLY = {"screen_fail_rate_null"}


class PublicationError(RuntimeError):
    """Checks that a publication violates; what was published before stays."""


def _count(cond: Column) -> Column:
    return F.coalesce(F.count_if(F.coalesce(cond, F.lit(False))), F.lit(0)).cast("long")


class Checks:
    """Collects the metrics of one publication."""

    def __init__(self) -> None:
        self.found: list[tuple[str, int]] = []
        self._open: list[tuple[Observation, list[str]]] = []

    def _observed(self, df: DataFrame, **metrics: Column) -> DataFrame:
        seen = Observation()
        self._open.append((seen, list(metrics)))
        return df.observe(seen, *[m.alias(n) for n, m in metrics.items()])

    def fact(self, dim_study: DataFrame, dim_site: DataFrame) -> Callable[[DataFrame], DataFrame]:
        """Q-02, Q-03, Q-04 on fact rows dealt by bucket: a key's rows are together, so no further shuffle
        finds a second one; the dimensions are broadcast within their checked size."""
        def watch(rows: DataFrame) -> DataFrame:
            again = F.row_number().over(Window.partitionBy("bucket", *FACT_KEY).orderBy("site_id")) > 1
            rows = rows.withColumn("_again", again)
            for c, dim in (("study_id", dim_study), ("site_id", dim_site)):
                rows = rows.join(bounded(dim, c).distinct().withColumn(f"_has_{c}", F.lit(True)), c, "left")
            own = F.col("_marker").isNull()
            late = F.col("consented_date").isNull() | (F.col("enrolled_date") < F.col("consented_date"))
            return self._observed(rows, fact_key_unique=_count(own & F.col("_again")), fact_key_not_null=_count(own & (F.col("patient_id").isNull() | F.col("study_id").isNull())),
                                  fact_study_fk=_count(own & F.col("_has_study_id").isNull()), fact_site_fk=_count(own & F.col("_has_site_id").isNull()),
                                  enrolled_implies_consent=_count(own & F.col("is_enrolled") & late))
        return watch

    def conversion(self, rows: DataFrame) -> DataFrame:
        """Q-05."""
        r, own = F.col("screen_fail_rate_pct"), F.col("_marker").isNull()
        return self._observed(rows, screen_fail_rate_in_range=_count(own & r.isNotNull() & ~r.between(0, 100)), screen_fail_rate_null=_count(own & r.isNull()))

    def diversity(self, rows: DataFrame) -> DataFrame:
        """Q-06: a study's shares are together in its bucket."""
        w = Window.partitionBy("bucket", "study_id")
        rows = rows.withColumn("_sum", F.sum("pct_of_study_enrolled").over(w)).withColumn("_place", F.row_number().over(w.orderBy("race_ethnicity", "sex")))
        return self._observed(rows, diversity_sums_to_100=_count(F.col("_marker").isNull() & (F.col("_place") == 1) & ~F.col("_sum").between(95, 105)))

    def forecast(self, rows: DataFrame) -> DataFrame:
        """Q-07, and Q-01 of the forecast."""
        missing = [c for c in FORECAST_FIELDS if c not in rows.columns]
        penalty = len(missing) + (dict(rows.dtypes).get("on_track") != "boolean")
        return self._observed(rows, **{"forecast_fields": _count(F.col("on_track").isNull()) + F.lit(penalty), "nonempty:kpi_predictability_forecast": (F.count("*") == 0).cast("long")})

    def overview(self, rows: DataFrame) -> DataFrame:
        """Q-08, and Q-01 of the overview."""
        r = F.col("pct_decentralized_enrolled")
        return self._observed(rows, **{"decentralized_share_in_range": _count(r.isNotNull() & ~r.between(0, 100)), "nonempty:kpi_overview": (F.count("*") == 0).cast("long")})

    def add(self, check: str, violations: int) -> None:
        self.found.append((check, violations))

    def stop_at_violations(self) -> None:
        """Take in the metrics of the writes so far; raise if one is violated."""
        for seen, names in self._open:
            got = seen.get
            self.found += [(n, int(got[n])) for n in names]
        self._open = []
        bad = [f"{n}: {v}" for n, v in self.found if v and n not in TOLD_ONLY]
        if bad:
            raise PublicationError("not published: " + ", ".join(bad))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(n, v, v == 0) for n, v in self.found], "check string, violations long, passed boolean")
