"""Anchor values of the sf0.01 fixture (FIXTURES.md §4)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tillpoint.operators import clean as C
from tillpoint.operators import customers, products, quality
from tillpoint.operators.filters import Filters
from tillpoint.plans.inputs import FixtureInputs


@pytest.fixture(scope="module")
def src(spark):
    return FixtureInputs(spark, SF01)


def test_row_counts(src):
    assert src.raw.count() == 61176
    prof = quality.duplicate_profile(src.raw).first()
    assert prof.duplicate_rows == 1177
    assert C.drop_exact_duplicates(C.fill_missing(src.raw)).count() == 59999
    assert src.clean.count() == 58720
    assert quality.key_check(src.clean.select(
        F.col("InvoiceNo").alias("invoiceno"), F.col("StockCode").alias("stockcode"),
        F.col("CustomerID").alias("customerid"))).first().unique_rows == 58661


def test_missing_and_value_counts(src):
    miss = {r.column_name: r.missing for r in quality.missing_profile(src.raw).collect()}
    assert (miss["Description"], miss["CustomerID"], miss["Country"]) == (1227, 6061, 2843)
    v = quality.value_checks(src.raw).first()
    assert (v.negative_quantity, v.zero_quantity, v.negative_price, v.zero_price) == (22058, 2217, 1306, 655)


def test_revenue_totals(src):
    t = src.clean.agg(F.sum("Revenue").alias("r"), F.sum("Net_Revenue").alias("n"),
                      F.count_if(F.col("Is_Free_Item") == "Yes").alias("free"),
                      F.count_if(F.col("Paid_UnitPrice") > 0).alias("paid")).first()
    assert t.r == Decimal("846900960.60")
    assert t.n == Decimal("341922631.40")
    assert (t.free, t.paid) == (646, 58074)


def test_units_sold_returned(src):
    # the anchor is taken on the cleaned lines (after the price filter)
    u = quality.unit_totals(src.clean).first()
    assert (u.total_sold, u.total_returned) == (901359, 537581)


def test_products_and_customers(src):
    counts = products.analyze_products(src.clean).counts.first()
    assert (counts.profitable, counts.loss) == (1628, 298)
    summ = src.summary
    assert summ.count() == 1350
    assert summ.filter(F.col("Total_Purchases") == 0).count() == 7
    assert summ.filter(F.col("Return_Rate").isNull() & (F.col("Total_Purchases") > 0)).count() == 15


def test_united_kingdom(src):
    # line anchors are on the cleaned lines (before the key dedup of the load)
    uk = src.clean.filter(F.col("Country") == "United Kingdom")
    r = uk.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("CustomerID").alias("c"),
               F.sum("Net_Revenue").alias("rev")).first()
    assert (r.n, r.c, r.rev) == (2106, 51, Decimal("12555684.00"))
    seg = customers.quartile_segments(customers.rfm_base(src.sales, Filters(country="United Kingdom"), ()), ())
    assert [x.customer_count for x in seg.orderBy("segment_order").collect()] == [13, 13, 12, 13]


def test_period_days(src):
    from tillpoint.operators.kpi import notebook_kpis

    period = notebook_kpis(src.sales).filter(F.col("metric") == "Data Period").first()
    assert period.value == 2404.0 and period.display == "2404 days"
