"""Randomised properties over generated raw lines with nulls,
returns, zero / negative prices and deliberate duplicate lines."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.operators import clean as C
from tillpoint.operators import customers, kpi, quality, trends
from tillpoint.schema import RAW_SCHEMA


def _random_raw(spark, seed, n=400):
    rng = np.random.default_rng(seed)
    base = dt.datetime(2010, 12, 1)
    rows = []
    for _ in range(n):
        rows.append((
            str(int(rng.integers(1, 60))),
            ["A", "B", "C", "M", "POST", "D"][int(rng.integers(0, 6))],
            None if rng.random() < 0.1 else ["mug", "lamp", "box"][int(rng.integers(0, 3))],
            int(rng.integers(-5, 12)),
            base + dt.timedelta(hours=int(rng.integers(0, 24 * 400))),
            None if rng.random() < 0.03 else Decimal(int(rng.integers(-50, 900))) / 100,
            None if rng.random() < 0.15 else f"c{int(rng.integers(1, 25))}",
            [None, "", "France", "Spain", "United Kingdom", "Unspecified"][int(rng.integers(0, 6))],
        ))
    rows += rows[: n // 10]  # exact copies
    return spark.createDataFrame(rows, RAW_SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_properties(spark, seed):
    raw = _random_raw(spark, seed)
    cl = C.clean_transactions(raw)
    # sale - return = quantity, line by line; no negative price survives
    assert cl.filter((F.col("Sale_Qty") - F.col("Return_Qty")) != F.col("Quantity")).count() == 0
    assert cl.filter(F.col("UnitPrice") < 0).count() == 0
    # dedup is idempotent and matches the duplicate profile
    filled = C.fill_missing(raw)
    once = C.drop_exact_duplicates(filled)
    assert C.drop_exact_duplicates(once).count() == once.count()
    prof = quality.duplicate_profile(filled).first()
    assert prof.unique_rows == once.count() and prof.total_rows == raw.count()
    assert quality.duplicate_rows(filled).count() == prof.duplicate_rows
    # the table load leaves unique keys; the one-pass load equals the two-step one
    sales = C.to_sales_table(cl)
    kc = quality.key_check(sales).first()
    assert kc.total_rows == kc.unique_rows
    assert C.sales_from_raw(raw).exceptAll(sales).count() == 0 and sales.count() == C.sales_from_raw(raw).count()
    # monthly series add up to the total
    total = sales.agg(F.sum("net_revenue")).first()[0] or 0
    monthly = trends.monthly_revenue(sales).agg(F.sum("revenue")).first()[0] or 0
    assert Decimal(monthly) == Decimal(total)
    # KPI block over all dates agrees with plain aggregates per country
    k = {r.country: r for r in kpi.kpi_block(sales).collect()}
    for r in sales.groupBy("country").agg(F.count(F.lit(1)).alias("n")).collect():
        assert k[r.country].total_transactions == r.n
    # segment counts add up to the customers of each country
    rfm = customers.rfm_base(sales)
    seg = customers.quartile_segments(rfm).groupBy("country").agg(F.sum("customer_count").alias("s"))
    per = rfm.groupBy("country").agg(F.count(F.lit(1)).alias("c"))
    joined = seg.join(per, seg.country.eqNullSafe(per.country))
    assert joined.filter(F.col("s") != F.col("c")).count() == 0 and joined.count() == per.count()
