"""Rankings: countries and products by revenue, volume or line count.

Global top-k (``orderBy().limit(k)``) plans as TakeOrderedAndProject: every
task keeps a k-row heap, so no full sort and no single-task gather. Per-group
top-k uses ``row_number() <= k``, for which Spark inserts a partial
WindowGroupLimit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import int_sum, label30, mean, money_sum
from .filters import Filters, apply_filters, known_country, positive

MONEY = "decimal(38,2)"


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def top_k_per_group(df: DataFrame, by, order, k: int) -> DataFrame:
    keys = _by(by)
    if not keys:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def country_revenue(sales: DataFrame, f: Filters | None = None) -> DataFrame:
    """Revenue and distinct customers per known country, highest first."""
    df = apply_filters(sales, f).filter(known_country("country"))
    customers = df.groupBy("country", "customerid").agg(money_sum("net_revenue", MONEY).alias("_net"))
    return (customers.groupBy("country")
            .agg(F.coalesce(money_sum("_net", MONEY), F.lit(0).cast(MONEY)).alias("revenue"),
                 F.count("customerid").alias("customers"))
            .orderBy(F.col("revenue").desc(), F.col("country")))


def product_totals(sales: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    df = apply_filters(sales, f).filter(F.col("description").isNotNull())
    return (df.groupBy(*_by(by), "description")
            .agg(F.coalesce(money_sum("net_revenue", MONEY), F.lit(0).cast(MONEY)).alias("revenue"),
                 F.count(F.lit(1)).alias("transactions")))


def top_products(sales: DataFrame, f: Filters | None = None, k: int = 10, by=("country",)) -> DataFrame:
    """The k products with the highest revenue per ``by`` group, with a
    30-character display label (P12)."""
    totals = product_totals(sales, f, by)
    top = top_k_per_group(totals, by, [F.col("revenue").desc(), F.col("description")], k)
    return top.withColumn("label", label30("description"))


def selected_products(sales: DataFrame, products, f: Filters | None = None, by=("country",)) -> DataFrame:
    """Revenue of the chosen products (F4), no limit."""
    from dataclasses import replace

    f = replace(f or Filters(), products=products)
    return (product_totals(sales, f, by).withColumn("label", label30("description"))
            .orderBy(*[F.col(k) for k in _by(by)], F.col("revenue").desc(), F.col("description")))


def top_products_by_volume(sales: DataFrame, k: int = 10, min_units: int = 100) -> DataFrame:
    """Best sellers among lines with units sold, HAVING units > min_units."""
    df = sales.filter(F.col("sale_qty") > 0)
    agg = df.groupBy("description").agg(
        F.count(F.lit(1)).alias("transactions"),
        int_sum("sale_qty").alias("total_quantity"),
        money_sum("net_revenue", MONEY).alias("total_revenue"),
        mean("unitprice").alias("avg_price"),
    )
    return (agg.filter(F.col("total_quantity") > min_units)
            .orderBy(F.col("total_revenue").desc(), F.col("description")).limit(k))


def top_countries(sales: DataFrame, k: int = 8, positive_only: bool = True) -> DataFrame:
    """A35 (positive lines) / A36 (all lines): top-k known countries by revenue."""
    df = sales.filter(known_country("country"))
    if positive_only:
        df = df.filter(positive("net_revenue"))
    return (df.groupBy("country").agg(money_sum("net_revenue", MONEY).alias("revenue"))
            .orderBy(F.col("revenue").desc(), F.col("country")).limit(k))


def countries_by_lines(sales: DataFrame, k: int = 10) -> DataFrame:
    """The k countries with the most lines."""
    return (sales.groupBy("country").agg(F.count(F.lit(1)).alias("transactions"))
            .orderBy(F.col("transactions").desc(), F.col("country").asc_nulls_first()).limit(k))
