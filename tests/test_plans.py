"""Plan properties over the materialized tables: no cartesian products,
pruned scans with pushed filters, bounded top-k, one scan for the KPI block."""

import pytest

from tests.conftest import SF001
from tillpoint.fixture import raw_transactions
from tillpoint.operators import kpi, trends
from tillpoint.operators.filters import Filters
from tillpoint.plans.registry import OPERATORS
from tillpoint.plans.warehouse import build_warehouse


@pytest.fixture(scope="module")
def wh(spark):
    import tempfile

    return build_warehouse(spark, raw_transactions(spark, SF001), tempfile.mkdtemp(prefix="tillpoint-plan-"),
                           keep_raw=True)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main_plan(df) -> str:
    """Physical plan without the subquery sections."""
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_cartesian_product_no_python(wh, name):
    p = plan(OPERATORS[name](wh))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # everything runs as JVM expressions: no Python UDF evaluation anywhere
    assert "EvalPython" not in p and "PythonUDF" not in p and "MapInPandas" not in p


@pytest.mark.parametrize("name", ["a4_top_profitable", "a1_worst_products", "a34_top_products_by_volume",
                                  "a35_top_countries_positive", "a37_countries_by_lines", "d5_top_duplicated_products"])
def test_global_top_k_is_take_ordered(wh, name):
    assert "TakeOrderedAndProject" in plan(OPERATORS[name](wh))


def test_top_k_per_group_limits_before_shuffle(wh):
    p = plan(OPERATORS["a32_top_products"](wh))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_kpi_block_pushes_its_ranges(wh):
    df = kpi.kpi_block(wh.sales, Filters(country="United Kingdom", start="1998-01-01", end="1998-12-31"))
    p = main_plan(df)
    # the lines of both windows, and a narrow scan of the previous window for its days
    assert p.count("FileScan parquet") == 2
    assert "PushedFilters: [IsNotNull(country), EqualTo(country,United Kingdom), Or(" in p
    assert "ReadSchema: struct<invoicedate:timestamp_ntz,country:string>" in p
    assert "Subquery" not in p  # bounds are literals


@pytest.mark.parametrize("name", ["a17_kpi_block", "a17_kpi_block_all_dates", "a38_financial_summary"])
def test_customers_are_summed_map_side_and_nothing_is_expanded(wh, name):
    p = plan(OPERATORS[name](wh))
    assert "Expand" not in p and "keys=[" in p and "customerid" in p


def test_column_pruning(wh):
    p = main_plan(trends.monthly_positive_revenue(wh.sales))
    assert "ReadSchema: struct<invoicedate:timestamp_ntz,net_revenue:decimal(12,2)>" in p
    assert "GreaterThan(net_revenue,0.00)" in p


def test_unknown_customer_filtered_at_scan(wh):
    p = main_plan(OPERATORS["a12_customer_summary"](wh))
    assert "Not(EqualTo(CustomerID,Unknown))" in p


def test_sales_table_is_one_map_side_combined_shuffle(spark):
    from tillpoint.plans.inputs import FixtureInputs

    p = plan(FixtureInputs(spark, SF001).sales)
    keyed = [line for line in p.splitlines() if "Exchange hashpartitioning" in line and "invoiceno" in line.lower()]
    assert len(keyed) == 1 and "customerid" in keyed[0]
    assert p.count("Exchange hashpartitioning") == 3  # the key dedup + the two sides of lines x orders
    assert "partial_min" in p  # copies and hot keys are combined before the shuffle


def test_exact_dedup_combines_copies_before_shuffle(spark):
    from tillpoint.plans.inputs import FixtureInputs

    p = plan(FixtureInputs(spark, SF001).clean)
    agg_lines = [i for i, line in enumerate(p.splitlines()) if "HashAggregate" in line or "Exchange hash" in line]
    kinds = ["X" if "Exchange" in p.splitlines()[i] else "A" for i in agg_lines]
    assert kinds[:3] == ["A", "X", "A"]  # final dedup, shuffle, partial dedup (top-down)


def test_monthly_layout_prunes_directories_and_keeps_results(spark, wh):
    import tempfile

    from pyspark.sql import functions as F

    from tillpoint.sources.sinks import export_rows

    monthly = build_warehouse(spark, wh.raw, tempfile.mkdtemp(prefix="tillpoint-monthly-"), layout="monthly")
    assert "invoice_month" in monthly.sales.columns
    f = Filters(country="United Kingdom", start="1998-01-01", end="1998-12-31")
    df = kpi.kpi_block(monthly.sales, f)
    p = main_plan(df)
    assert "PartitionFilters: [isnotnull(invoice_month" in p and "1997-" in p  # previous window pruned too
    cols = [c for c in kpi.kpi_block(wh.sales, f).columns]
    a = sorted(map(tuple, kpi.kpi_block(wh.sales, f).select(cols).collect()), key=repr)
    b = sorted(map(tuple, df.select(cols).collect()), key=repr)
    assert a == b
    assert export_rows(monthly.sales, f).columns == export_rows(wh.sales, f).columns
    m1 = trends.monthly_revenue(wh.sales, f).orderBy("month").collect()
    m2 = trends.monthly_revenue(monthly.sales, f).orderBy("month").collect()
    assert m1 == m2 and F is not None
