"""Time trends: monthly series, period comparison, weekday and hour profiles.

All operators group by ``by`` (default: country) so one pass serves every
country; pass a ``Filters`` with a country to get a single one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import int_sum, money_sum, month_start, weekday0, weekday_abbr
from ..schema import DAY_ABBREVIATIONS
from .filters import Filters, apply_filters, positive, prune_months, ts_bound

MONEY = "decimal(38,2)"


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def monthly_revenue(sales: DataFrame, f: Filters | None = None, by=("country",),
                    label_fmt: str = "MMM yy") -> DataFrame:
    """Revenue per month (all lines) with a display label."""
    df = apply_filters(sales, f)
    g = df.groupBy(*_by(by), month_start("invoicedate").alias("month"))
    out = g.agg(F.coalesce(money_sum("net_revenue", MONEY), F.lit(0).cast(MONEY)).alias("revenue"))
    return out.withColumn("month_label", F.date_format("month", label_fmt)).orderBy(*_by(by), "month")


def monthly_positive_revenue(sales: DataFrame, f: Filters | None = None, by=()) -> DataFrame:
    """Revenue per month over positive lines only (the report's series)."""
    df = apply_filters(sales, f).filter(positive("net_revenue"))
    return (df.groupBy(*_by(by), month_start("invoicedate").alias("month"))
            .agg(money_sum("net_revenue", MONEY).alias("monthly_revenue")).orderBy(*_by(by), "month"))


def monthly_sales(sales: DataFrame, f: Filters | None = None, by=()) -> DataFrame:
    """Positive-line revenue, line count and units sold per month."""
    df = apply_filters(sales, f).filter(positive("net_revenue"))
    return (df.groupBy(*_by(by), month_start("invoicedate").alias("month"))
            .agg(money_sum("net_revenue", MONEY).alias("monthly_revenue"),
                 F.count(F.lit(1)).alias("transactions"),
                 int_sum("sale_qty").alias("items_sold")).orderBy(*_by(by), "month"))


def peak_month(monthly: DataFrame, value: str = "monthly_revenue", by=(), label_fmt: str = "MMM yyyy") -> DataFrame:
    """The month with the highest value (earliest month on ties)."""
    key = F.struct((-F.col(value)).alias("v"), F.col("month").alias("m"))
    out = monthly.groupBy(*_by(by)).agg(F.min_by("month", key).alias("peak_month"),
                                        F.max(value).alias("peak_revenue"))
    return out.withColumn("peak_label", F.date_format("peak_month", label_fmt))


def months_in_window(start, end):
    """Number of calendar months the inclusive window touches."""
    s, e = ts_bound(start), ts_bound(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s)) + 1


def monthly_comparison(sales: DataFrame, f: Filters, mode: str = "yoy", by=("country",)) -> DataFrame:
    """Monthly revenue next to the revenue of the comparison month.

    ``mode='yoy'``: same month one year earlier; ``mode='prev'``: the month
    ``n`` months earlier, n = months in the selected window. Comparison months
    are whole, the window's first and last month are cut by its bounds. One
    scan reads from the first comparison month to the window's end; the
    comparison is a range window over the month-grain sums, gap-safe (a missing
    month gives NULL, never a neighbour's value as ``lag`` would).
    """
    keys = _by(by)
    if mode == "none":
        return monthly_revenue(sales, f, keys)
    if mode == "yoy":
        shift = 12
    elif mode == "prev":
        if not f.has_range:
            raise ValueError("mode='prev' needs a date range")
        shift = sales.sparkSession.range(1).select(months_in_window(f.start, f.end)).first()[0]
    else:
        raise ValueError(f"unknown comparison mode {mode!r}")
    df, when = apply_filters(sales, f.without_dates()), F.col("invoicedate")
    inside = F.lit(True)
    if f.start is not None:
        first = F.timestamp_add("MONTH", F.lit(-shift), month_start(ts_bound(f.start)))
        df = prune_months(df, first, None).where(when >= first)
        inside &= when >= ts_bound(f.start)
    if f.end is not None:
        df = prune_months(df, None, f.end).where(when <= ts_bound(f.end))
    money = F.lit(0).cast(MONEY)
    months = (df.withColumn("_in", inside).withColumn("_part", F.when(inside, F.col("net_revenue")))
              .groupBy(*keys, month_start("invoicedate").alias("month"))
              .agg(F.coalesce(money_sum("_part", MONEY), money).alias("revenue"), F.bool_or("_in").alias("_in"),
                   F.coalesce(money_sum("net_revenue", MONEY), money).alias("_all")))
    index = F.year("month") * 12 + F.month("month")
    back = Window.partitionBy(*keys).orderBy("_index").rangeBetween(-shift, -shift)
    return (months.withColumn("_index", index).withColumn("compare_revenue", F.max("_all").over(back)).where("_in")
            .select(*keys, "month", "revenue", F.date_format("month", "MMM yy").alias("month_label"),
                    F.timestamp_add("MONTH", F.lit(-shift), F.col("month")).alias("compare_month"), "compare_revenue")
            .orderBy(*keys, "month"))


def sales_by_weekday(sales: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    """Revenue and line count per day of week (0 = Sunday)."""
    df = apply_filters(sales, f)
    return (df.groupBy(*_by(by), weekday0("invoicedate").alias("day_num"),
                       weekday_abbr("invoicedate").alias("day_name"))
            .agg(F.coalesce(money_sum("net_revenue", MONEY), F.lit(0).cast(MONEY)).alias("revenue"),
                 F.count(F.lit(1)).alias("transactions")).orderBy(*_by(by), "day_num"))


def hour_weekday_revenue(sales: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    """Revenue per (day of week, hour), long form."""
    df = apply_filters(sales, f)
    return (df.groupBy(*_by(by), weekday0("invoicedate").alias("day_num"),
                       F.hour("invoicedate").alias("hour"))
            .agg(F.coalesce(money_sum("net_revenue", MONEY), F.lit(0).cast(MONEY)).alias("revenue"))
            .orderBy(*_by(by), "day_num", "hour"))


def hour_weekday_heatmap(sales: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    """Hour x weekday grid, one column per true weekday (Sun..Sat), 0 filled.

    The pivot values are given, so Spark plans it as one aggregate with no
    extra pass to discover them.
    """
    df = apply_filters(sales, f).withColumn("day_num", weekday0("invoicedate"))
    keys = _by(by) + [F.hour("invoicedate").alias("hour")]
    grid = (df.groupBy(*keys).pivot("day_num", list(range(7)))
            .agg(money_sum("net_revenue", MONEY)))
    renamed = grid.select(*_by(by), "hour",
                          *[F.coalesce(F.col(str(i)), F.lit(0).cast(MONEY)).alias(d.lower())
                            for i, d in enumerate(DAY_ABBREVIATIONS)])
    return renamed.orderBy(*_by(by), "hour")
