"""Driver tables -> the eleven landing source shapes (the mapping of FIXTURES.md §3).

Each function takes the lazy table dict and returns a typed DataFrame with the source's
declared columns. Every shape is derived from whole driver tables, so its size grows with them.

Scale notes
* studies/sites come from region/nation (5 and 25 rows by the TPC-H definition) and are
  broadcast-safe by construction.
* funnel stage numbering needs the rank of each event inside its (user, k) group, but only up
  to 7. ``row_number() <= 7`` is planned by Spark as a *partial* per-partition group limit
  before the shuffle (WindowGroupLimit), so a hot group ships at most 7 rows per map task
  instead of all its rows; the ranks are joined back on the unique event id.
* patients, their re-extract and the funnel all need an event's study slot, which lies in JSON.
  ``event_slots`` has it parsed; a caller that stores that table among the others (``Landed``) has
  the events read and parsed once for the three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import padded_id, pick

STUDY_W, SITE_W, PATIENT_W, EVENT_W = 3, 3, 8, 10


def _k(events: DataFrame) -> Column:
    """Study slot of an event: integer ``$.k`` of props, modulo the number of studies."""
    return F.get_json_object(events["props"], "$.k").cast("int") % C.N_STUDIES


def study_id_of(c: Column) -> Column:
    return padded_id("STU-", c, STUDY_W)


def site_id_of(c: Column) -> Column:
    return padded_id("SITE-", c, SITE_W)


def patient_id_of(user_id: Column, k: Column) -> Column:
    return padded_id("PT-", user_id * 10 + k, PATIENT_W)


def _race(segment: Column) -> Column:
    expr = None
    for seg, race in C.SEGMENT_RACE.items():
        expr = (F.when(segment == seg, race) if expr is None else expr.when(segment == seg, race))
    return expr.otherwise(C.RACE_ETHNICITY[-1])


def studies(t) -> DataFrame:
    r = t["region"]
    rk = F.col("r_regionkey")
    return r.select(
        study_id_of(rk).alias("study_id"),
        F.concat(F.upper(F.substr("r_name", F.lit(1), F.lit(3))), F.lit("-"), (rk + 1000).cast("string")).alias("protocol_number"),
        padded_id("Sponsor-", rk, STUDY_W).alias("sponsor"),
        F.col("r_name").alias("therapeutic_area"),
        pick(C.PHASES, rk % 3).alias("phase"),
        (F.lit(40) + rk * 20).cast("int").alias("target_enrollment"),
        (F.lit(100) - rk * 15).cast("int").alias("planned_duration_days"),
        F.lit("2024-01-01").cast("date").alias("start_date"),
    )


def sites(t) -> DataFrame:
    n, r = t["nation"], t["region"]
    nk = F.col("n_nationkey")
    # region: a handful of rows; a runtime broadcast by AQE when measured small
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.select(
        site_id_of(nk).alias("site_id"),
        F.concat(F.col("n_name"), F.lit(" Research Center")).alias("site_name"),
        pick(C.SITE_TYPES, nk % 3).alias("site_type"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("state"),
        F.date_add(F.lit("2023-01-01").cast("date"), nk).alias("activated_date"),
        F.concat(F.lit("Dr. "), F.col("n_name")).alias("pi_name"),
    )


def _customer_attrs(t, moved: bool = False) -> DataFrame:
    """Patient attributes from a customer; ``moved``: customers whose key ends in 0 sit at the
    next nation's site (the second extract of the SCD2 scenario)."""
    c = t["customer"]
    ck = F.col("c_custkey")
    nation = F.col("c_nationkey")
    if moved:
        nation = F.when(ck % 10 == 0, (nation + 1) % 25).otherwise(nation)
    return c.select(
        ck.alias("user_id"),
        site_id_of(nation).alias("site_id"),
        (F.lit(18) + ck % 72).cast("int").alias("age"),
        pick(C.SEXES, ck % 2).alias("sex"),
        _race(F.col("c_mktsegment")).alias("race_ethnicity"),
        (F.col("c_acctbal") < 0).alias("is_rural"),
    )


def event_slots(t) -> DataFrame:
    """(event_id, ts, user_id, k) of every event."""
    e = t["events"]
    return e.select("event_id", "ts", "user_id", _k(e).alias("k"))


def _slots(t) -> DataFrame:
    return t["event_slots"] if "event_slots" in t else event_slots(t)


def patients(t) -> DataFrame:
    """One row per distinct (user, k) of events, with the customer's attributes."""
    uk = _slots(t).select("user_id", "k").distinct()
    j = uk.join(_customer_attrs(t), "user_id")
    return j.select(
        patient_id_of(F.col("user_id"), F.col("k")).alias("patient_id"),
        study_id_of(F.col("k")).alias("study_id"),
        "site_id", "age", "sex", "race_ethnicity", "is_rural",
    )


def funnel_events(t) -> DataFrame:
    """One funnel event per driver event: the n-th event of a (user, k) group reaches stage
    ``min(n, 1 + (3·user + 5·k) mod 7)``; later events repeat that stage (duplicates)."""
    e = _slots(t)
    w = Window.partitionBy("user_id", "k").orderBy("ts", "event_id")
    first7 = (e.withColumn("n", F.row_number().over(w))
               .filter(F.col("n") <= len(C.FUNNEL_STAGES))
               .select("event_id", "n"))
    ranked = e.join(first7, "event_id", "left")
    cap = F.lit(1) + (F.col("user_id") * 3 + F.col("k") * 5) % len(C.FUNNEL_STAGES)
    n = F.coalesce(F.col("n"), F.lit(len(C.FUNNEL_STAGES) + 1))
    cust = t["customer"].select(F.col("c_custkey").alias("user_id"), site_id_of(F.col("c_nationkey")).alias("site_id"))
    j = ranked.join(cust, "user_id")
    return j.select(
        patient_id_of(F.col("user_id"), F.col("k")).alias("patient_id"),
        study_id_of(F.col("k")).alias("study_id"),
        "site_id",
        pick(C.FUNNEL_STAGES, F.least(n, cap) - 1).alias("stage"),
        F.col("ts").cast("date").alias("event_date"),
    )


def _brand_no(c: Column) -> Column:
    return F.substr(c, F.lit(7)).cast("int")


def campaigns(t) -> DataFrame:
    b = t["part"].select("p_brand").distinct()
    bn = _brand_no(F.col("p_brand"))
    return b.select(
        F.col("p_brand").alias("campaign_id"),
        study_id_of(bn % C.N_STUDIES).alias("study_id"),
        pick(C.CHANNELS, bn % 4).alias("channel"),
        pick(C.REGIONS, bn % 5).alias("geo"),
        F.lit("2024-01-01").cast("date").alias("start_date"),
    )


def marketing_daily(t) -> DataFrame:
    """Campaign x day: spend, impressions, clicks, leads from lineitem joined to part."""
    li = t["lineitem"].select("l_partkey", "l_extendedprice", "l_quantity", F.col("l_shipdate").cast("date").alias("activity_date"))
    p = t["part"].select("p_partkey", "p_brand")
    j = li.join(p, li["l_partkey"] == p["p_partkey"])
    g = j.groupBy("p_brand", "activity_date").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("spend_usd"),
        (F.sum("l_quantity") * 100).cast("bigint").alias("impressions"),
        (F.count(F.lit(1)) * 5).cast("bigint").alias("clicks"),
        F.count(F.lit(1)).cast("bigint").alias("leads"),
    )
    bn = _brand_no(F.col("p_brand"))
    return g.select(
        F.col("p_brand").alias("campaign_id"),
        study_id_of(bn % C.N_STUDIES).alias("study_id"),
        "activity_date",
        pick(C.CHANNELS, bn % 4).alias("channel"),
        "spend_usd", "impressions", "clicks", "leads",
    )


def study_budgets(t) -> DataFrame:
    rk = F.col("r_regionkey")
    return t["region"].select(
        study_id_of(rk).alias("study_id"),
        F.lit("USD").alias("currency"),
        ((F.lit(40) + rk * 20) * 12000).cast("double").alias("total_budget_usd"),
    )


def site_costs(t) -> DataFrame:
    """Study x site x month operating cost from orders joined to customer."""
    o = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = t["customer"].select("c_custkey", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    g = j.groupBy(
        study_id_of(F.col("o_orderkey") % C.N_STUDIES).alias("study_id"),
        site_id_of(F.col("c_nationkey")).alias("site_id"),
        F.date_trunc("month", F.col("o_orderdate")).cast("date").alias("month"),
    ).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("operating_cost_usd"),
        F.min(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("per_visit_cost_usd"),
    )
    return g


def visits(t) -> DataFrame:
    e = t["events"]
    v = e.filter(F.col("event_type") == "view")
    k = _k(v)
    return v.select(
        padded_id("V-", F.col("event_id"), EVENT_W).alias("visit_id"),
        patient_id_of(F.col("user_id"), k).alias("patient_id"),
        study_id_of(k).alias("study_id"),
        (F.lit(1) + F.col("event_id") % 8).cast("int").alias("visit_number"),
        F.col("ts").cast("date").alias("visit_date"),
        F.when(F.col("value") >= 5, "completed").otherwise("missed").alias("status"),
    )


def adverse_events(t) -> DataFrame:
    e = t["events"]
    a = e.filter(F.col("event_type") == "error")
    k = _k(a)
    return a.select(
        padded_id("AE-", F.col("event_id"), EVENT_W).alias("ae_id"),
        patient_id_of(F.col("user_id"), k).alias("patient_id"),
        study_id_of(k).alias("study_id"),
        pick(C.SEVERITIES, F.col("event_id") % 3).alias("severity"),
        (F.col("value") > 90).alias("serious_flag"),
        F.col("ts").cast("date").alias("onset_date"),
    )


def invoices(t) -> DataFrame:
    o = t["orders"]
    ok = F.col("o_orderkey")
    st = None
    for code, label in C.INVOICE_STATUS.items():
        st = F.when(F.col("o_orderstatus") == code, label) if st is None else st.when(F.col("o_orderstatus") == code, label)
    return o.select(
        padded_id("INV-", ok, EVENT_W).alias("invoice_id"),
        study_id_of(ok % C.N_STUDIES).alias("study_id"),
        padded_id("Sponsor-", ok % C.N_STUDIES, STUDY_W).alias("sponsor"),
        F.col("o_totalprice").alias("amount_usd"),
        pick(C.MILESTONES, ok % 4).alias("milestone"),
        st.otherwise(None).alias("status"),
        F.col("o_orderdate").cast("date").alias("invoice_date"),
    )


BUILDERS = {
    "studies": studies,
    "sites": sites,
    "patients": patients,
    "funnel_events": funnel_events,
    "visits": visits,
    "adverse_events": adverse_events,
    "campaigns": campaigns,
    "marketing_daily": marketing_daily,
    "study_budgets": study_budgets,
    "site_costs": site_costs,
    "invoices": invoices,
}


def source(t, name: str) -> DataFrame:
    return BUILDERS[name](t)


def patients_changed(t) -> DataFrame:
    """Second patient extract for the SCD2 scenario: a full re-extract of every patient in which
    customers whose key ends in 0 have moved to the next site (nation + 1). Other rows repeat
    unchanged and must not open versions."""
    uk = _slots(t).select("user_id", "k").distinct()
    j = uk.join(_customer_attrs(t, moved=True), "user_id")
    return j.select(
        patient_id_of(F.col("user_id"), F.col("k")).alias("patient_id"),
        study_id_of(F.col("k")).alias("study_id"),
        "site_id", "age", "sex", "race_ethnicity", "is_rural",
    )
