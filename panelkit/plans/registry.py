"""Name -> query function and name -> oracle SQL, in one place."""

from __future__ import annotations

from panelkit.plans import files, oracle, queries

QUERY_NAMES = [
    "macro_merge", "structural_missing", "asof_day_end", "asof_month_end_status",
    "keep_last", "keep_first", "dup_report", "latest_n", "latest_periods", "lag_features",
    "running_max_drop", "index100", "base_period_index", "price_level", "gap_check",
    "chrono_split", "latest_row", "profile", "describe", "value_counts", "conditional_counts",
    "coverage", "pearson", "spearman", "corr_gap", "lagged_corr", "histogram", "sigma_outliers",
    "reg_metrics", "pivot_year", "unpivot_predictions", "intersect_periods", "any_column_search",
    "typed_filters", "date_parse", "fiscal_period", "real_income", "real_change", "pressure_gap",
    "turning_points", "burden", "lexicon_score", "text_panel", "phrase_audit", "payload_kind",
    "extract_links", "latest_snapshot", "ols", "scenario", "scenario_range", "scenario_grid",
    "forest", "model_metrics", "clean_release", "month_end_rate", "price_release", "income_release",
    "top_customers", "month_growth", "phrase_hits", "contract_report", "income_long_release",
    "rank_orders", "rank_by_priority", "split_orders", "lag_orders", "running_max_orders", "rate_layouts",
    "contract_violations", "column_tools", "row_tools", "label_scores", "sorted_ranks", "ols_multi", "frozen_evaluation",
    "preview", "frozen_values", "null_keys",
]


def query_functions() -> dict:
    return {n: getattr(queries, n) for n in QUERY_NAMES} | {n: getattr(files, n) for n in files.NAMES}


def oracle_sql() -> dict:
    return {n: oracle.SQL[n] for n in [*QUERY_NAMES, *files.NAMES] if n in oracle.SQL}
