"""Registry of driver-table workloads exposed through ``__spark_entry__.queries()``."""

from __future__ import annotations

from strata.plans import workloads as W
from strata.plans.flow_workloads import FLOW_QUERIES

QUERIES = {
    "md3_orders_clean": W.md3_orders_clean,
    "win_dedup_latest_lineitem": W.win_dedup_latest_lineitem,
    "win_dedup_authoritative_documents": W.win_dedup_authoritative_documents,
    "md1_part_attributes": W.md1_part_attributes,
    "md2_tiering_scd1": W.md2_tiering_scd1,
    "md4_weather_classify": W.md4_weather_classify,
    "md5_label_knockout": W.md5_label_knockout,
    "md6_calendar_parts": W.md6_calendar_parts,
    "jn_coverage_gap": W.jn_coverage_gap,
    "jn_coverage_gap_two_key": W.jn_coverage_gap_two_key,
    "jn_exists_flag": W.jn_exists_flag,
    "jn_exists_flag_filtered": W.jn_exists_flag_filtered,
    "jn_append_new_only": W.jn_append_new_only,
    "agg_append_counts": W.agg_append_counts,
    "jn_lookup_default": W.jn_lookup_default,
    "jn_left_enrich_two_keys": W.jn_left_enrich_two_keys,
    "jn_spine_expected_demand": W.jn_spine_expected_demand,
    "fn_hour_profile": W.fn_hour_profile,
    "snk_upsert_result": W.snk_upsert_result,
    "snk_upsert_counts": W.snk_upsert_counts,
    "src_json_flatten": W.src_json_flatten,
    "src_array_zip": W.src_array_zip,
    "src_partition_prune_scan": W.src_partition_prune_scan,
    "src_csv_contract_scan": W.src_csv_contract_scan,
    "stream_dedup_events": W.stream_dedup_events,
    "agg_duplicate_keys": W.agg_duplicate_keys,
    "agg_frequency_share": W.agg_frequency_share,
    "agg_order_profile": W.agg_order_profile,
    "agg_ingest_summary": W.agg_ingest_summary,
    "agg_conditional_counts": W.agg_conditional_counts,
    "dq_report": W.dq_report,
    "dq_freshness": W.dq_freshness,
    "inc_next_range": W.inc_next_range,
    "fn_surrogate_key": W.fn_surrogate_key,
    "fn_round_clamp": W.fn_round_clamp,
    "fn_safe_divide": W.fn_safe_divide,
    "set_union_all": W.set_union_all,
    "prj_clean_text": W.prj_clean_text,
    **FLOW_QUERIES,
}
