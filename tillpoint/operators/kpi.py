"""KPI blocks, growth vs previous period, summaries and long-form KPI lists.

Several of the analysed application's separate queries are folded into one
aggregate pass each: conditional aggregates (``sum(when(window, x))``) give
the current and the previous window from a single scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import int_sum, mean, money_sum, ratio, safe_ratio
from ..functions.format import format_pattern, format_value
from ..schema import COMPLETENESS_OK_PCT
from .filters import Filters, apply_filters, in_range, non_blank, previous_period, prune_months

MONEY = "decimal(38,2)"


def _zero_money():
    return F.lit(0).cast(MONEY)


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


# --- dashboard KPI block (A17 - A20) -----------------------------------------

def kpi_block(sales: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    """A17 + A19, then A18 / A20 as column arithmetic.

    Current window: the filter's [start, end]; previous window: F16 bounds.
    Without a date range every line is current and there is no previous
    window (growth status 'na').

    Two distinct counts in one aggregate would expand every row. Lines are
    summed by customer, map-side, and a customer is then a row; the days with
    data are counted from a narrow scan of the previous window alone.
    """
    f = f or Filters()
    keys = _by(by)
    df = apply_filters(sales, f, dates=False)
    ts = F.col("invoicedate")
    if f.has_range:
        cur = in_range(ts, f.start, f.end)
        days, prev_start, prev_end = previous_period(f.start, f.end)
        prev = ts.between(prev_start, prev_end)
        before = prune_months(df, prev_start, prev_end).filter(prev)
        df = prune_months(df, prev_start, f.end).filter(cur | prev)
    else:
        cur, prev, days, before = F.lit(True), F.lit(False), F.lit(0), None
    customers = df.groupBy(*keys, "customerid").agg(*_line_sums(cur, prev))
    agg = _block_of_customers(customers, keys)
    zero = F.lit(0).cast("bigint")
    if before is None:
        agg = agg.withColumn("days_with_data", zero)
    else:
        dates = before.select(*keys, F.to_date(ts).alias("_day"))
        agg = with_count(agg, dates.groupBy(*keys, "_day").agg(F.count(F.lit(1)).alias("_n")), keys, "_day", "days_with_data")
    return derive_kpis(agg.withColumn("expected_days", days.cast("bigint")))


def _line_sums(cur: Column, prev: Column) -> list[Column]:
    """What the block needs of a customer's lines."""
    net, items = F.col("net_revenue"), F.col("total_items")
    return [
        money_sum(F.when(cur, net), MONEY).alias("_net"),
        F.count(F.when(cur, net)).alias("_net_n"),
        F.count_if(cur).alias("_lines"),
        int_sum(F.when(cur, F.col("sale_qty"))).alias("_sold"),
        int_sum(F.when(cur, F.col("return_qty"))).alias("_returned"),
        int_sum(F.when(cur, items)).alias("_items"),
        F.count(F.when(cur, items)).alias("_items_n"),
        F.count_if(prev).alias("_prev_lines"),
        money_sum(F.when(prev, net), MONEY).alias("_prev_net"),
    ]


def _block_of_customers(customers: DataFrame, keys: list[str]) -> DataFrame:
    """Sums per customer -> the block's columns, without ``days_with_data``."""
    zero = F.lit(0).cast("bigint")
    return customers.groupBy(*keys).agg(
        F.coalesce(money_sum("_net", MONEY), _zero_money()).alias("total_revenue"),
        F.coalesce(int_sum("_lines"), zero).alias("total_transactions"),
        F.coalesce(ratio(F.sum("_net"), F.sum("_net_n")), F.lit(0.0)).alias("avg_order"),
        F.count_if((F.col("_lines") > 0) & F.col("customerid").isNotNull()).alias("total_customers"),
        F.coalesce(int_sum("_sold"), zero).alias("total_qty"),
        F.coalesce(int_sum("_returned"), zero).alias("return_qty"),
        F.coalesce(ratio(F.sum("_items"), F.sum("_items_n")), F.lit(0.0)).alias("avg_items_exact"),
        F.coalesce(int_sum("_prev_lines"), zero).alias("prev_records"),
        F.coalesce(money_sum("_prev_net", MONEY), _zero_money()).alias("prev_revenue"),
    )


def with_count(agg: DataFrame, rows: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """``agg`` (one row per ``keys``) with ``name``: how many of ``rows``, which are
    distinct, have a value in ``column``."""
    zero = F.lit(0).cast("bigint")
    if not keys:
        return agg.withColumn(name, F.coalesce(rows.select(F.count(column)).scalar(), zero))
    per = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(column).alias("_count"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return agg.join(per, same, "left").select(*agg.columns, F.coalesce("_count", zero).alias(name))


def derive_kpis(agg: DataFrame) -> DataFrame:
    """A18 + A20 on top of the aggregated block."""
    total = F.col("total_revenue").cast("double")
    prev = F.col("prev_revenue").cast("double")
    completeness = safe_ratio("days_with_data", "expected_days") * F.lit(100.0)
    growth = F.when(F.col("prev_revenue") > 0, (total - prev) / prev * F.lit(100.0))
    out = agg.withColumns({
        "return_rate": safe_ratio("return_qty", "total_qty") * F.lit(100.0),
        "avg_items": F.bround(F.col("avg_items_exact"), 0),
        "revenue_per_customer": safe_ratio(F.col("total_revenue"), "total_customers"),
        "data_completeness": completeness,
        "growth_pct": growth,
    })
    return out.withColumns({
        "growth_status": F.when(F.col("prev_revenue") <= 0, F.lit("na"))
        .when(F.col("data_completeness") < F.lit(COMPLETENESS_OK_PCT), F.lit("partial"))
        .otherwise(F.lit("ok")),
        "growth_trend": F.when(F.col("growth_pct") >= 0, F.lit("up"))
        .when(F.col("growth_pct") < 0, F.lit("down")),
    })


def kpi_cards(kpis: DataFrame, by=("country",), keep_values: bool = False) -> DataFrame:
    """Display strings of the KPI block (the dashboard's eight cards).

    keep_values=True returns the KPI columns and the cards together, so one
    aggregate serves both.
    """
    g = F.col("growth_pct")
    growth_text = F.concat(F.when(g >= 0, F.lit("+")).otherwise(F.lit("")), format_pattern(g, "0.0"), F.lit("%"))
    growth_display = (F.when(F.col("growth_status") == "na", F.lit("N/A"))
                      .when(F.col("growth_status") == "partial", F.concat(growth_text, F.lit("*")))
                      .otherwise(growth_text))
    lead = list(kpis.columns) if keep_values else _by(by)
    return kpis.select(
        *lead,
        F.concat(F.lit("$"), F.format_number(F.col("total_revenue").cast("double"), 0)).alias("revenue_card"),
        F.format_number(F.col("total_transactions"), 0).alias("transactions_card"),
        F.concat(F.lit("$"), F.format_number(F.col("avg_order"), 0)).alias("avg_order_card"),
        F.format_number(F.col("total_customers"), 0).alias("customers_card"),
        F.concat(format_pattern(F.col("return_rate"), "0.0"), F.lit("%")).alias("return_rate_card"),
        format_pattern(F.col("avg_items"), "0.0").alias("items_card"),
        growth_display.alias("growth_card"),
        F.concat(F.lit("$"), F.format_number(F.col("revenue_per_customer"), 0)).alias("revenue_per_customer_card"),
    )


# --- bounds, domains, one-row summaries ----------------------------------------

def date_bounds(sales: DataFrame, ts: str = "invoicedate") -> DataFrame:
    """First and last line timestamps."""
    return sales.agg(F.min(ts).alias("min_date"), F.max(ts).alias("max_date"))


def data_period(sales: DataFrame, ts: str = "invoicedate") -> DataFrame:
    """First / last sale and the span between them.

    ``data_period`` is a day-time interval; ``period_days`` (whole days) and
    ``period_seconds`` carry the same span as plain numbers.
    """
    b = sales.agg(F.min(ts).alias("first_sale"), F.max(ts).alias("last_sale"))
    span = F.col("last_sale") - F.col("first_sale")
    return b.select("first_sale", "last_sale", span.alias("data_period"),
                    F.extract(F.lit("DAY"), span).cast("bigint").alias("period_days"),
                    F.timestamp_diff("SECOND", F.col("first_sale"), F.col("last_sale")).alias("period_seconds"))


def distinct_values(sales: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-blank values of one column (filter domains)."""
    return sales.select(col).filter(non_blank(col)).distinct().orderBy(col)


def financial_summary(sales: DataFrame) -> DataFrame:
    """One row of totals and distinct counts. Lines are summed by customer,
    map-side, and a customer is then a row; products are counted by a scan of
    their column alone, as a scalar: no row is expanded."""
    customers = sales.groupBy("customerid").agg(
        money_sum("revenue", MONEY).alias("_revenue"),
        money_sum("net_revenue", MONEY).alias("_net"),
        int_sum("sale_qty").alias("_sold"),
        int_sum("return_qty").alias("_returned"),
    )
    products = sales.select(F.count_distinct("stockcode")).scalar()
    return customers.agg(
        money_sum("_revenue", MONEY).alias("total_revenue"),
        money_sum("_net", MONEY).alias("total_net_revenue"),
        int_sum("_sold").alias("total_items_sold"),
        int_sum("_returned").alias("total_items_returned"),
        F.count("customerid").alias("unique_customers"),
    ).withColumn("unique_products", products)


def pipeline_summary(clean: DataFrame, customer_summary: DataFrame, product_counts: DataFrame) -> DataFrame:
    """Lines, revenue, net revenue, customers, top customer revenue,
    profitable / loss product counts, as one row.

    The three inputs have different grains; their one-row results are joined
    as scalar subqueries (each evaluated once), not by a cross join.
    """
    base = clean.agg(F.count(F.lit(1)).alias("total_rows"),
                     money_sum("Revenue").alias("total_revenue"),
                     money_sum("Net_Revenue").alias("net_revenue"))
    return base.select(
        "*",
        customer_summary.select(F.count(F.lit(1))).scalar().alias("total_customers"),
        customer_summary.select(F.max("Total_Net_Revenue")).scalar().alias("top_customer_revenue"),
        product_counts.select("profitable").scalar().alias("profitable_products"),
        product_counts.select("loss").scalar().alias("loss_products"),
    )


# --- long-form KPI lists (A40, A41) --------------------------------------------

@dataclass(frozen=True)
class Metric:
    name: str
    value: Column
    fmt: str


def _long(one_row: DataFrame, metrics: list[Metric], style: str, extra: dict | None = None) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("position"), F.lit(m.name).alias("metric"),
                     m.value.cast("double").alias("value"), F.lit(m.fmt).alias("format"))
            for i, m in enumerate(metrics)]
    long = one_row.select(F.inline(F.array(*rows)))
    if style == "notebook":
        long = long.withColumn("value", F.coalesce(F.col("value"), F.lit(0.0)))
    long = long.withColumn("display", format_value("value", F.col("format"), style))
    for k, v in (extra or {}).items():
        long = long.withColumn(k, F.lit(v))
    return long


def report_kpis(sales: DataFrame, run_timestamp: str) -> DataFrame:
    """The report's KPI list (metric, value, display, format, run_timestamp)."""
    net, pos = F.col("net_revenue"), F.col("net_revenue") > 0
    one = sales.agg(
        F.sum(F.when(pos, net)).alias("rev"),
        mean(net, pos).alias("aov"),
        F.count_distinct("customerid").alias("cust"),
        F.count_if(F.col("total_items") > 0).alias("lines"),
    )
    metrics = [Metric("Total Revenue", F.col("rev"), "currency"),
               Metric("Avg Order Value", F.col("aov"), "currency"),
               Metric("Total Customers", F.col("cust"), "count"),
               Metric("Total Transactions", F.col("lines"), "count")]
    return _long(one, metrics, "report", {"run_timestamp": run_timestamp}) \
        .select("position", "metric", "value", "display", "format", "run_timestamp")


def notebook_kpis(sales: DataFrame) -> DataFrame:
    """The extended KPI list (adds return rate, period, daily revenue,
    items per line); a missing value counts as 0."""
    net, pos, ts = F.col("net_revenue"), F.col("net_revenue") > 0, F.col("invoicedate")
    one = sales.agg(
        F.sum(F.when(pos, net)).alias("rev"),
        mean(net, pos).alias("aov"),
        F.count_distinct("customerid").alias("cust"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("sale_qty").alias("sold"),
        F.sum("return_qty").alias("returned"),
        F.min(ts).alias("lo"), F.max(ts).alias("hi"),
        F.min(F.when(pos, ts)).alias("pos_lo"), F.max(F.when(pos, ts)).alias("pos_hi"),
        mean("total_items", F.col("total_items") > 0).alias("items"),
    )
    period = F.extract(F.lit("DAY"), F.col("hi") - F.col("lo")) + 1
    pos_period = F.extract(F.lit("DAY"), F.col("pos_hi") - F.col("pos_lo")) + 1
    ret_rate = F.when(F.col("sold") > 0, (F.col("returned") * 100).cast("double") / F.col("sold").cast("double")) \
        .otherwise(F.lit(0.0))
    daily = F.col("rev").cast("double") / F.nullif(pos_period, F.lit(0)).cast("double")
    metrics = [Metric("Total Revenue", F.col("rev"), "currency"),
               Metric("Avg Order Value", F.col("aov"), "currency"),
               Metric("Total Customers", F.col("cust"), "count"),
               Metric("Total Transactions", F.col("lines"), "count"),
               Metric("Return Rate", ret_rate, "percent"),
               Metric("Data Period", period, "days"),
               Metric("Avg Daily Revenue", daily, "currency"),
               Metric("Items per Transaction", F.col("items"), "decimal")]
    return _long(one, metrics, "notebook").select("position", "metric", "value", "display", "format")
