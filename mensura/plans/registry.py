"""Registered queries: one per operator family of the survey inventory.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables.  Oracle SQL lives in the ``oracle*`` modules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (audits, basics, market, national, oracle, oracle_audits, oracle_basics, oracle_market, oracle_pages, oracle_resources, oracle_rules,
               oracle_profiles, oracle_refined, oracle_refined_a, oracle_scalars, oracle_workbook, pages, profiles, refined_a, refined_b,
               resources, rules, scalars, subcode, workbook)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    # national series (source A)
    "k1_reconciliation_audit": national.reconciliation_audit,
    "k1_national_base": national.national_base,
    "k7_national_monthly": national.national_monthly,
    "k8_national_annual": national.national_annual,
    # markets (source A)
    "k2_market_values": market.market_all,
    "k2_published_indicators": market.published_all,
    "k2_alias_collisions": market.alias_collisions,
    "k3_market_base": market.market_base,
    "k9_market_serving": market.market_serving,
    "k10_regional_serving": market.regional_serving,
    "k4_comparative": market.comparative,
    "k9_comparative_serving": market.comparative_serving,
    "k5_dim_destination": market.dim_destination,
    "k5_date_spine": market.date_spine,
    "k6_market_fact": market.market_fact,
    "k6_national_fact": national.national_fact,
    "k6_comparative_fact": market.comparative_fact,
    "k11_kpi_national": market.kpi,
    # sub-code star schema (source B)
    "k12_enriched_subcode": subcode.enriched,
    "k12_dim_date": subcode.dim_date,
    "k12_dim_product": subcode.dim_product,
    "k12_dim_subcode": subcode.dim_subcode,
    "k13_fact_subcode": subcode.fact,
    "k14_monthly_summary": subcode.monthly_summary,
    "k14_annual_summary": subcode.annual_summary,
    "k15_flat_serving": subcode.serving,
    "k16_kpi_subcode": subcode.kpi,
    # data-quality rule registries
    "d_silver_b_rules": rules.silver_b,
    "d_gold_b_rules": rules.gold_b,
    "d_silver_a_rules": rules.silver_a,
    "d_gold_a_rules": rules.gold_a,
    "d_gold_fact_rules": rules.gold_facts,
    "d_gold_dimension_rules": rules.gold_dimensions,
    "d_gold_pregates": rules.gold_pregates,
    "s18_open_refined": refined_a.opened,
    "d_c_layer_contract": refined_a.published_contract,
    "d_qa_published": refined_a.published_suite,
    # scalar functions over whole tables
    "o1_clean_text": scalars.clean_documents,
    "o2_normalize_match": scalars.fold_documents,
    "o3_canonical_label": scalars.canonical_part_names,
    "o4_number_tokens": scalars.number_tokens,
    "o6_parse_date": scalars.event_dates,
    "o11_parse_period": scalars.period_roundtrip,
    "o25_safe_filename": scalars.page_file_names,
    # ingest snapshots (sources)
    "s1_latest_manifest": resources.latest_manifests,
    "s2_eligible_records": resources.eligible,
    "s3_s4_period_selection": resources.chosen_period,
    "s5_newest_file": resources.newest_files,
    "s6_integrity": resources.integrity,
    "s16_snapshot_status": resources.snapshot_status,
    "s17_version_names": resources.version_names,
    "s13_discover_links": pages.links,
    "s14_page_fingerprint": pages.fingerprints,
    "s15_fingerprint_changes": pages.fingerprint_changes,
    # workbook cells
    "s7_read_range": workbook.read_matrix,
    "f7_typed_projection": workbook.typed,
    "f7_conversion_audit": workbook.typed_audit,
    "p1_unpivot_months": workbook.unpivoted,
    "s8_check_ranges": workbook.range_checks,
    "s9_locate_header": workbook.headers,
    "s10_sheet_extent": workbook.extents,
    "s11_structure_hash": workbook.structure,
    "s12_extract_records": workbook.records,
    "k17_refined_a": refined_a.refined,
    "k17_rules": refined_a.refined_rules,
    "k17_audit": refined_a.audit,
    "k18_refined_subcode": refined_b.refined,
    # generic aggregate / set / join / ordering operators
    "a3_profile": profiles.profile_subcode,
    "a4_density": profiles.density_subcode,
    "a5_null_cells": profiles.null_cells_reconciliation,
    "a6_duplicate_keys": profiles.duplicate_documents,
    "a7_conflicts": profiles.conflicting_languages,
    "a8_label_list": profiles.languages_per_source,
    "a9_histogram": profiles.event_histogram,
    "a10_totals_rollup": profiles.event_totals,
    "a11_catalogue": profiles.subcode_catalogue,
    "a12_latest_by": profiles.latest_year_by_cut,
    "a13_conservation": profiles.conservation_subcode,
    "a14_group_totals": profiles.market_group_totals,
    "u2_diff": profiles.snapshot_diff,
    "u3_dedup_audit": profiles.dedup_documents,
    "u4_dedup_subset": profiles.dedup_subset,
    "u6_calendar_gaps": profiles.order_status_gaps,
    "u7_coverage": profiles.label_coverage,
    "j10_fk_orphans": profiles.label_orphans,
    "j11_reconcile_totals": profiles.totals_reconciliation,
    "l2_latest_row": profiles.latest_month,
    "l3_top_of_latest": profiles.top_subcode_latest,
    "p2_unpivot_indicators": profiles.indicators_long,
    # operators that the composites write out
    "o15_code_labels": basics.code_labels,
    "o19_years_in_names": basics.years_in_names,
    "o26_o27_months": basics.months,
    "o29_row_hashes": basics.row_hashes,
    "f3_null_observations": basics.null_observations,
    "f4_f5_analytic_labels": basics.analytic_labels,
    "f8_contract_projection": basics.contract_projection,
    "p3_units": basics.units,
    "p4_indicators": basics.indicators,
    "p5_calendar": basics.calendar,
    "j3_j6_customers": basics.customers_of_orders,
    # reproducibility audit
    "r7_schema_contracts": audits.schema_contracts,
    "r1_fingerprints": audits.fingerprints,
    "r4_status_counts": audits.rule_status_counts,
    "r6_expected_rows": audits.expected_rows,
    "r8_compare_runs": audits.compare_runs,
}

ORACLE: dict[str, str] = {**oracle.SQL, **oracle_market.SQL, **oracle_rules.SQL, **oracle_scalars.SQL,
                          **oracle_resources.SQL, **oracle_pages.SQL, **oracle_workbook.SQL,
                          **oracle_profiles.SQL, **oracle_refined.SQL, **oracle_refined_a.SQL,
                          **oracle_audits.SQL, **oracle_basics.SQL}
