"""Daily rollup: the dashboard's time panels (A17-A28) without the lines.

``sales_hours`` has one row per country and hour with the sums and counts that the
panels need, ``customer_days`` one per country, day and customer for the distinct
customers. Both are sums or sets over lines, so a load adds its own rows beside
those of other loads (``sources.versions.append_load``) and nothing is rebuilt.

The panels take bounds at midnight, as a picked date is. Since a bare end date
means its midnight, lines at exactly midnight must be told from the rest of the
hour: a row's ``invoicedate`` is the start of its hour, and one microsecond later
for the other lines of the first hour. So every operator over lines that filters by
such bounds and groups by hour, day or month gives the same on these rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import int_sum, money_sum, month_start, ratio, weekday0, weekday_abbr
from . import kpi, trends
from .filters import Filters, apply_filters, in_range, positive, previous_period

MONEY = "decimal(38,2)"
_TICK = "INTERVAL '0.000001' SECOND"


def _hour(ts: Column) -> Column:
    """The start of the hour; a microsecond later after the day's first instant."""
    day = F.to_date(ts).cast("timestamp_ntz")
    start = F.timestamp_add("HOUR", F.hour(ts), day)
    return F.when((F.hour(ts) == 0) & (ts != day), start + F.expr(_TICK)).otherwise(start)


def _day(ts: Column) -> Column:
    day = F.to_date(ts).cast("timestamp_ntz")
    return F.when(ts != day, day + F.expr(_TICK)).otherwise(day)


def sales_hours(sales: DataFrame) -> DataFrame:
    """One row per country and hour (lines without a date: one per country)."""
    net, pos = F.col("net_revenue"), F.col("net_revenue") > 0
    return sales.groupBy("country", _hour(F.col("invoicedate")).alias("invoicedate")).agg(
        money_sum(net, MONEY).alias("net_revenue"),
        F.count(net).alias("net_lines"),
        F.count(F.lit(1)).alias("lines"),
        int_sum("sale_qty").alias("sale_qty"),
        int_sum("return_qty").alias("return_qty"),
        int_sum("total_items").alias("total_items"),
        F.count("total_items").alias("item_lines"),
        money_sum(F.when(pos, net), MONEY).alias("positive_revenue"),
        F.count_if(pos).alias("positive_lines"),
        int_sum(F.when(pos, F.col("sale_qty"))).alias("positive_sale_qty"),
    )


def customer_days(sales: DataFrame) -> DataFrame:
    """The customers of each country and day."""
    return sales.select("country", _day(F.col("invoicedate")).alias("invoicedate"), "customerid").distinct()


def covers(f: Filters | None) -> bool:
    """Whether the rollup can answer for these filters: no products, and bounds
    that are none or at midnight (of bounds that are columns nothing is known)."""
    def midnight(v) -> bool:
        if v is None:
            return True
        if isinstance(v, str):
            try:
                v = dt.datetime.fromisoformat(v)
            except ValueError:
                return False
        if isinstance(v, dt.datetime):
            return v.time() == dt.time()
        return isinstance(v, dt.date)

    return f is None or (f.products is None and midnight(f.start) and midnight(f.end))


def _checked(f: Filters | None) -> Filters:
    if not covers(f):
        raise ValueError("the rollup answers for bounds at midnight and all products only")
    return f or Filters()


def rollup_kpi_block(hours: DataFrame, customers: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    """A17-A20 from the rollup: ``kpi.kpi_block`` of the lines."""
    f, keys = _checked(f), kpi._by(by)
    ts = F.col("invoicedate")
    hours, customers = (apply_filters(t, f, dates=False) for t in (hours, customers))
    if f.has_range:
        cur = in_range(ts, f.start, f.end)
        days, prev_start, prev_end = previous_period(f.start, f.end)
        prev = ts.between(prev_start, prev_end)
        before = hours.filter(prev)
        hours, customers = hours.filter(cur | prev), customers.filter(cur)
    else:
        cur, prev, days, before = F.lit(True), F.lit(False), F.lit(0), None
    zero, none = F.lit(0).cast("bigint"), F.lit(0).cast(MONEY)

    def total(name: str, where: Column) -> Column:
        return F.coalesce(int_sum(F.when(where, F.col(name))), zero)

    net = F.when(cur, F.col("net_revenue"))
    agg = hours.groupBy(*keys).agg(
        F.coalesce(money_sum(net, MONEY), none).alias("total_revenue"),
        total("lines", cur).alias("total_transactions"),
        F.coalesce(ratio(F.sum(net), F.sum(F.when(cur, F.col("net_lines")))), F.lit(0.0)).alias("avg_order"),
        total("sale_qty", cur).alias("total_qty"),
        total("return_qty", cur).alias("return_qty"),
        F.coalesce(ratio(F.sum(F.when(cur, F.col("total_items"))), F.sum(F.when(cur, F.col("item_lines")))), F.lit(0.0)).alias("avg_items_exact"),
        total("lines", prev).alias("prev_records"),
        F.coalesce(money_sum(F.when(prev, F.col("net_revenue")), MONEY), none).alias("prev_revenue"),
    )
    each = customers.groupBy(*keys, "customerid").agg(F.count(F.lit(1)).alias("_n"))
    agg = kpi.with_count(agg, each, keys, "customerid", "total_customers")
    if before is None:
        agg = agg.withColumn("days_with_data", zero)
    else:
        dates = before.groupBy(*keys, F.to_date(ts).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
        agg = kpi.with_count(agg, dates, keys, "_day", "days_with_data")
    return kpi.derive_kpis(agg.withColumn("expected_days", days.cast("bigint")))


def rollup_monthly(hours: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    """A22."""
    return trends.monthly_revenue(hours, _checked(f), by)


def rollup_comparison(hours: DataFrame, f: Filters, mode: str = "yoy", by=("country",)) -> DataFrame:
    """A21."""
    return trends.monthly_comparison(hours, _checked(f), mode, by)


def rollup_monthly_sales(hours: DataFrame, f: Filters | None = None, by=()) -> DataFrame:
    """Positive revenue, lines and units per month (A25: ``peak_month``
    of it)."""
    keys = kpi._by(by)
    df = apply_filters(hours, _checked(f)).filter(positive("positive_lines"))
    return (df.groupBy(*keys, month_start("invoicedate").alias("month"))
            .agg(money_sum("positive_revenue", MONEY).alias("monthly_revenue"), int_sum("positive_lines").alias("transactions"),
                 int_sum("positive_sale_qty").alias("items_sold")).orderBy(*keys, "month"))


def rollup_weekday(hours: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    """A26."""
    keys = kpi._by(by)
    return (apply_filters(hours, _checked(f))
            .groupBy(*keys, weekday0("invoicedate").alias("day_num"), weekday_abbr("invoicedate").alias("day_name"))
            .agg(F.coalesce(money_sum("net_revenue", MONEY), F.lit(0).cast(MONEY)).alias("revenue"), int_sum("lines").alias("transactions"))
            .orderBy(*keys, "day_num"))


def rollup_hours(hours: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    """A27."""
    return trends.hour_weekday_revenue(hours, _checked(f), by)


def rollup_heatmap(hours: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    """A28."""
    return trends.hour_weekday_heatmap(hours, _checked(f), by)
