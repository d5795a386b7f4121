"""Every registered query equals its DuckDB oracle on the sf0.001 tables
(row count, column names and types, order-insensitive value hash)."""

import re

import pytest

import __spark_entry__ as entry
from compare import compare
from conftest import SF_SMALL
from tillroll.plans.registry import ORACLE, QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, wh_small, name):
    df = QUERIES[name](spark, SF_SMALL)
    r = compare(df, duck_small, ORACLE[name])
    assert r["columns_equal"], r
    assert not r["type_diff"], r["type_diff"]
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_equal"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "year_month", "gross_revenue", "net_revenue", "previous_month_gross_revenue", "gross_revenue_growth_pct"
    ]
    assert df.count() > 0


BY_INVOICE = r"Exchange hashpartitioning\([^)]*invoice_no"
PLANS = {
    "monthly_growth": BY_INVOICE, "revenue_pareto": BY_INVOICE, "example_top_merchandise": BY_INVOICE,
    "cancellation_ratio_ranking": BY_INVOICE, "country_revenue_share": BY_INVOICE,
    "dq_distinct_values": "Expand", "code_merge_report": "Expand", "val_constraints": "Expand", "val_unique_lineage": "Expand",
    "val_report": "Expand", "v_customer_kpis": "Expand", "rfm_scores": "Sort|rangepartitioning", "rfm_segments": "Sort|rangepartitioning",
}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_plan_has_no(spark, wh_small, name):
    """Sums are combined before any shuffle by invoice; no key rule expands rows."""
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(PLANS[name], plan)
