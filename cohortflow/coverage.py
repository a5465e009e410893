
COVERAGE = {
    # 2.1 scans, sources, sinks
    "S-01": ("sources.landing.read_landing, sources.quarantine.read_checked", ["s01_csv_scan"]),
    "S-02": ("streaming.ingest.ingest / ingest_all", ["s02_stream_ingest", "t01_runs_per_load", "e2e_medallion_overview"]),
    "S-03": ("sources.bronze.stamp / stamp_from_metadata", ["s03_ingest_stamp", "s02_stream_ingest"]),
    "S-04": ("operators.watermark.extract_since / extract_ties", ["s04_extract_since", "s04_marks"]),
    "S-05": ("sources.landing.read_evolving, streaming.ingest.ingest_evolving", ["s05_schema_evolution", "s05_stream_evolution"]),
    "S-06": ("sources.driver_tables.load_tables", ["s06_scan_invoices"]),
    "S-07": ("sources.landing.write_parquet", ["s07_parquet_sink"]),
    "S-08": ("streaming.ingest.start_ingest (parquet append sink)", ["s02_stream_ingest", "t01_runs_per_load"]),
    "S-09": ("sources.landing.save_table", ["s09_table_sink"]),
    "S-10": ("createOrReplaceTempView + spark.sql", ["s10_sql_view_speed"]),
    "S-11": ("sources.landing.create_if_absent, operators.scd2.empty_like", ["s11_create_if_absent"]),
    "S-12": ("sources.bronze.file_ledger", ["s12_file_ledger"]),
    # 2.2 table mutation
    "M-01": ("operators.scd2.scd2_apply, merged by key bucket (operators.bucketed)", ["m01_scd2_history", "e2e_medallion_scd2"]),
    "M-02": ("operators.scd2.surrogate_key", ["m02_surrogate_keys"]),
    "M-03": ("operators.upsert.first_wins_upsert, merged by key bucket", ["m03_upsert_funnel", "t03_stream_silver"]),
    "M-04": ("operators.watermark.read_mark / read_marks / mark_frame", ["m04_marks_after_run1", "l03_backlog"]),
    "M-05": ("operators.watermark.advance", ["m05_marks_after_run2"]),
    "M-06": ("a load replaces its own partitions, a batch with marks is left out (plans.silver_state)", ["m06_replay_is_noop"]),
    "M-07": ("operators.bucketed.BucketedTable (as of a load)", ["m07_versions", "m07_read_as_of"]),
    # 2.3 projections, filters
    "P-01": ("plans.silver.study", ["d01_dim_study"]),
    "P-02": ("plans.silver.site", ["d02_dim_site"]),
    "P-03": ("plans.silver.patient", ["p03_patient"]),
    "P-04": ("plans.silver.marketing", ["d07_fact_marketing_daily"]),
    "P-05": ("plans.silver.campaign", ["d04_dim_campaign"]),
    "P-06": ("plans.silver.site_costs", ["d08_fact_site_financials"]),
    "P-07": ("plans.silver.budget", ["p07_budget"]),
    "P-08": ("operators.scd2.current_view", ["d03_dim_patient"]),
    "P-09": ("plans.gold.fact_patient_enrollment (flags)", ["d06_fact_patient_enrollment"]),
    "P-10": ("plans.gold.fact_patient_enrollment (cycle times)", ["d06_fact_patient_enrollment"]),
    "P-11": ("plans.dashboard.pick_studies", ["p11_slicer"]),
    "P-12": ("operators.watermark.after_mark", ["l03_backlog", "m04_marks_after_run1"]),
    "P-13": ("plans.kpi.forecast (status)", ["k06_forecast", "b05_forecast_table"]),
    # 2.4 joins
    "J-01": ("plans.gold.fact_patient_enrollment (join on patient, study)", ["d06_fact_patient_enrollment"]),
    "J-02": ("plans.kpi.speed_study (aggregate, then left join)", ["k01_speed_study"]),
    "J-03": ("plans.kpi.reach / decentralized_share (bounded site dim)", ["k04_reach", "k08_decentralized_share"]),
    "J-04": ("plans.kpi.overview", ["k07_overview"]),
    "J-05": ("plans.kpi.forecast (left joins + coalesce)", ["k06_forecast"]),
    "J-06": ("left_anti joins in plans.quality.referential_integrity", ["q03_referential_integrity"]),
    "J-07": ("operators.scd2.scd2_apply (current rows only meet the batch)", ["m01_scd2_history"]),
    "J-08": ("star joins of facts to dims", ["j08_star_spend_by_channel", "x10_pct_decentralized"]),
    "J-09": ("role-playing date join", ["d05_dim_date"]),
    # 2.5 aggregations
    "A-01": ("operators.pivot.milestone_pivot", ["d06_fact_patient_enrollment"]),
    "A-02": ("operators.pivot.representative", ["d06_fact_patient_enrollment"]),
    "A-03": ("operators.aggregates.count_if", ["k05_conversion"]),
    "A-04": ("operators.aggregates.avg_if", ["k01_speed_study"]),
    "A-05": ("distinct sites per group; plans.distinct (bitmap states)", ["k04_reach"]),
    "A-06": ("operators.aggregates.sum_by", ["k09_cost_per_enrolled"]),
    "A-07": ("min date and day difference", ["k01_speed_study"]),
    "A-08": ("functions.scalar.safe_div / pct", ["k05_conversion", "x07_screen_fail_rate"]),
    "A-09": ("operators.aggregates.groups_with_more_than", ["l05_multi_version_keys"]),
    "A-10": ("plans.kpi.speed_site_weekly", ["k02_speed_site_weekly"]),
    # 2.6 windows
    "W-01": ("operators.dedup.first_per_key", ["w01_first_per_key"]),
    "W-02": ("operators.aggregates.share_of_partition", ["k03_diversity"]),
    # 2.7 sort and set
    "O-01": ("orderBy on extracts and lineage reports", ["s04_extract_since", "l08_forecast_slack"]),
    "O-02": ("unionByName of labelled counts", ["l01_layer_counts"]),
    # 2.8 scalar functions
    "F-01": ("functions.scalar.typed (try_cast), sources.quarantine.rejects", ["f01_typed_rejects"]),
    "F-02": ("date_add", ["d01_dim_study"]),
    "F-03": ("functions.scalar.days_between", ["d06_fact_patient_enrollment", "l08_forecast_slack"]),
    "F-04": ("functions.scalar.week_start", ["k02_speed_site_weekly"]),
    "F-05": ("functions.calendar.date_dim", ["d05_dim_date"]),
    "F-06": ("functions.calendar.date_dim (distributed day range)", ["d05_dim_date"]),
    "F-07": ("coalesce / nullif / zero_floor", ["k06_forecast", "k09_cost_per_enrolled"]),
    "F-08": ("functions.scalar.round_half_up", ["k05_conversion"]),
    "F-09": ("functions.scalar.round_half_even", ["k06_forecast"]),
    "F-10": ("functions.scalar.trunc_int", ["k06_forecast"]),
    "F-11": ("isin / when / isNull", ["d02_dim_site", "d06_fact_patient_enrollment"]),
    "F-12": ("config.Params (as_of, batch timestamps)", ["k06_forecast", "m01_scd2_history"]),
    # 2.9 streaming
    "T-01": ("trigger(availableNow=True)", ["t01_runs_per_load"]),
    "T-02": ("checkpointLocation", ["t01_runs_per_load", "s02_stream_ingest"]),
    "T-03": ("streaming.incremental.run_silver_funnel", ["t03_stream_silver"]),
    # 2.10 governance
    "U-01": ("operators.governance.mask_column", ["u01_mask_column"]),
    "U-02": ("operators.governance.row_filter / by_site", ["u02_row_filter"]),
    "U-03": ("operators.governance.secured", ["u03_secured_view", "u04_admin_view"]),
    # 2.11 marts
    "D-01": ("plans.gold.build_star", ["d01_dim_study"]),
    "D-02": ("plans.gold.build_star", ["d02_dim_site"]),
    "D-03": ("plans.gold.build_star", ["d03_dim_patient"]),
    "D-04": ("plans.gold.build_star", ["d04_dim_campaign"]),
    "D-05": ("functions.calendar.date_dim", ["d05_dim_date"]),
    "D-06": ("plans.gold.fact_patient_enrollment; kept up by plans.gold_state", ["d06_fact_patient_enrollment"]),
    "D-07": ("plans.gold.build_star", ["d07_fact_marketing_daily"]),
    "D-08": ("plans.gold.build_star", ["d08_fact_site_financials"]),
    "K-01": ("plans.kpi.speed_study", ["k01_speed_study"]),
    "K-02": ("plans.kpi.speed_site_weekly", ["k02_speed_site_weekly"]),
    "K-03": ("plans.kpi.diversity", ["k03_diversity"]),
    "K-04": ("plans.kpi.reach", ["k04_reach"]),
    "K-05": ("plans.kpi.conversion", ["k05_conversion"]),
    "K-06": ("plans.kpi.forecast", ["k06_forecast"]),
    "K-07": ("plans.kpi.overview", ["k07_overview", "e2e_medallion_overview"]),
    "K-08": ("plans.kpi.decentralized_share", ["k08_decentralized_share"]),
    "K-09": ("plans.kpi.cost_per_enrolled", ["k09_cost_per_enrolled"]),
    # 2.12 measures
    **{f"X-{i:02d}": (f"plans.measures.{name}", [key]) for i, (key, name) in enumerate([
        ("x01_avg_days_to_first_patient", "avg_days_to_first_patient"),
        ("x02_avg_lead_to_enrolled_days", "avg_lead_to_enrolled_days"),
        ("x03_enrolled_recent", "enrolled_recent"),
        ("x04_weekly_velocity", "weekly_velocity"),
        ("x05_enrolled_to_date", "enrolled_to_date"),
        ("x06_pct_to_target", "pct_to_target"),
        ("x07_screen_fail_rate", "screen_fail_rate"),
        ("x08_studies_on_track", "studies_on_track"),
        ("x09_studies_at_risk", "studies_at_risk"),
        ("x10_pct_decentralized", "pct_decentralized"),
        ("x11_pct_underrepresented", "pct_underrepresented"),
        ("x12_total_marketing_spend", "total_marketing_spend"),
        ("x13_total_site_cost", "total_site_cost"),
        ("x14_cost_per_enrolled", "cost_per_enrolled"),
        ("x15_acquisition_cost_per_enrolled", "acquisition_cost_per_enrolled"),
    ], start=1)},
    # 2.13 dashboard
    "B-01": ("plans.dashboard.header_cards", ["b01_header_cards", "e2e_served_header_cards"]),
    "B-02": ("plans.dashboard.weekly_trend", ["b02_weekly_trend"]),
    "B-03": ("plans.dashboard.enrolled_by_race", ["b03_enrolled_by_race"]),
    "B-04": ("plans.dashboard.enrolled_by_site_type", ["b04_enrolled_by_site_type"]),
    "B-05": ("plans.dashboard.forecast_table", ["b05_forecast_table"]),
    "B-06": ("plans.dashboard.study_panels", ["b06_study_panels", "e2e_served_study_panels"]),
    # 2.14 lineage
    "L-01": ("plans.lineage.layer_counts", ["l01_layer_counts"]),
    "L-02": ("plans.lineage.rows_per_load", ["l02_rows_per_load"]),
    "L-03": ("plans.lineage.backlog", ["l03_backlog"]),
    "L-04": ("plans.lineage.version_history", ["l04_version_history"]),
    "L-05": ("plans.lineage.multi_version_keys", ["l05_multi_version_keys"]),
    "L-06": ("plans.lineage.trace_patient / duplicates_removed", ["l06_trace_patient", "l09_duplicates_removed"]),
    "L-07": ("plans.lineage.funnel_arithmetic", ["l07_funnel_arithmetic"]),
    "L-08": ("plans.lineage.forecast_slack", ["l08_forecast_slack"]),
    # 2.15 quality
    "Q-01": ("plans.quality.nonempty", ["q01_nonempty"]),
    "Q-02": ("plans.quality.fact_key", ["q02_fact_key"]),
    "Q-03": ("plans.quality.referential_integrity", ["q03_referential_integrity"]),
    "Q-04": ("plans.quality.funnel_monotonic", ["q04_funnel_monotonic"]),
    "Q-05": ("plans.quality.screen_fail_range", ["q05_screen_fail_range"]),
    "Q-06": ("plans.quality.diversity_sums", ["q06_diversity_sums"]),
    "Q-07": ("plans.quality.forecast_fields", ["q07_forecast_fields"]),
    "Q-08": ("plans.quality.decentralized_range", ["q08_decentralized_range"]),
}

# measures evaluated under other filter contexts (non-study groupings, attribute filters)
COVERAGE["X-05"][1].append("xctx_enrolled_by_site_type_phase2")
COVERAGE["X-06"][1].append("xctx_pct_to_target_by_region")
COVERAGE["X-07"][1].append("xctx_screen_fail_by_area")
COVERAGE["X-13"][1].append("x13_site_cost_by_region")
COVERAGE["L-04"][1].append("l04_history_of_chosen")
COVERAGE["L-06"][1].append("l06_trace_chosen")
for _id, _key in (("B-01", "b01_header_cards_picked"), ("B-02", "b02_weekly_trend_picked"), ("B-03", "b03_enrolled_by_race_picked"),
                  ("P-11", "b01_header_cards_picked")):
    COVERAGE[_id][1].append(_key)

# kept-up state, quarantine, roll-up and bitmap states, observed checks
for _key, _ids in {
    "f01_quarantine": ("S-01", "F-01"), "f01_loaded_beside": ("F-01",), "s04_tie_extract": ("S-04", "M-04"), "s04_tie_marks": ("M-05",), "t03_changed_keys": ("T-03",),
    "a05_distinct_by_site_type": ("A-05", "K-04"), "a05_distinct_enrolled_by_week": ("A-05",), "x08_x09_distinct_studies": ("X-08", "X-09"), "u02_row_filter_pruned": ("U-02",),
    "e2e_fact_patient_enrollment": ("D-06",), "d06_cells": ("D-06",), "e2e_kpi_speed_study": ("K-01",), "e2e_kpi_speed_site_weekly": ("K-02",), "e2e_kpi_accessibility_diversity": ("K-03",),
    "e2e_kpi_accessibility_reach": ("K-04",), "e2e_kpi_predictability_conversion": ("K-05",), "e2e_kpi_predictability_forecast": ("K-06",),
    "xnav_avg_lead_to_enrolled_days_by_total": ("X-02",), "xnav_enrolled_recent_by_region": ("X-03",), "xnav_enrolled_to_date_by_race_ethnicity_sex": ("X-05",),
    "xnav_enrolled_to_date_by_age": ("X-05",), "xnav_screen_fail_rate_by_site_id": ("X-07",), "e2e_checks": tuple(f"Q-0{k}" for k in range(1, 9)), "m07_versions": ("M-06",),
}.items():
    for _id in _ids:
        COVERAGE[_id][1].append(_key)
