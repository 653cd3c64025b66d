"""Registered queries against their DuckDB oracles on the smallest data set.

One or two queries per inventory group (model layers, joins, aggregates, windows,
scalar functions, gates and tests, measures, reports, incremental); the full set runs
at sf0.01 through ``check_oracle.py``.
"""

import pytest

from conftest import SF_SMALL

SAMPLE = [
    "t_sales_performance", "s16_staging_view", "p11_recent_orders", "j4_star_join_fact",
    "a1_group_by_13", "a9_scalar_max", "w1_dedup_latest_per_order", "w5_lag_growth_pct",
    "w8_calendar_rolling_12m_revenue", "o3_top5_products_per_year", "u1_date_union",
    "f07_month_name_padded", "f18_format_percent", "q7_source_gates", "q10_relationship_tests",
    "m07_yoy_revenue_growth", "m20_region_revenue_share", "d2_time_drill_level3",
    "r4_time_heatmap", "i3_dim_date_watermark", "t6_stable_geography_ids",
]


@pytest.fixture(scope="module")
def registry():
    from salesmart.registry import ORACLE, QUERIES
    return QUERIES, ORACLE


@pytest.fixture(scope="module")
def duck():
    from salesmart.checks import duck_connection
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, registry, duck, name):
    from salesmart.checks import compare
    queries, oracle = registry
    res = compare(queries[name](spark, SF_SMALL), duck, oracle[name])
    assert res["rows_match"] and res["schema_match"] and res["values_match"], res


def test_every_query_has_an_oracle(registry):
    queries, oracle = registry
    assert set(queries) == set(oracle)


FLAWED = ["p4_defaulted_values", "p6_missing_natural_keys", "p9_orders_dropped_by_star_join", "p10_raw_totals_inconsistent",
          "j6_orphan_product_fk", "j7_relationship_tests", "a8_conditional_null_counts", "q2_gate_null_order_id_rate",
          "q3_gate_null_order_date_rate", "q6_gate_positive_units", "q8_not_null_tests", "q9_unique_tests", "q10_relationship_tests"]


@pytest.mark.parametrize("name", FLAWED)
def test_checks_find_the_planted_defects(spark, registry, name):
    """Every count of every row is positive (of a gate: its value; of a declared test: its failures)."""
    rows = registry[0][name](spark, SF_SMALL).collect()
    columns = [c for c in ("FAILURES", "VALUE", "FAILING_ROWS") if c in rows[0]] or list(rows[0].asDict())
    assert rows and all(r[c] > 0 for r in rows for c in columns)


def test_lists_of_planted_defects_are_not_empty(spark, registry):
    for name in ("p13_dates_above_watermark", "q11_financial_integrity"):
        assert registry[0][name](spark, SF_SMALL).count() > 0
