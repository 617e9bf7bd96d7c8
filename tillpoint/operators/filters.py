"""Filter values and predicates shared by the dashboard-style operators.

``Filters`` holds what a user picks: country, an inclusive date range and a
product list. Bounds may be literals (``'2011-03-01'`` = midnight) or Spark
columns, e.g. the data-anchored quick ranges, which are scalar subqueries:
computed once, then used as constants, so no join appears in the plan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import shift_days, whole_days_between
from ..schema import NON_PRODUCT_CODES, QUICK_RANGE_DAYS, UNKNOWN_CUSTOMER, UNSPECIFIED_COUNTRY

Bound = "str | dt.datetime | dt.date | Column | None"


@dataclass(frozen=True)
class Filters:
    country: str | None = None
    start: object = None  # inclusive lower bound
    end: object = None  # inclusive upper bound
    products: object = None  # sequence of descriptions, or a one-column DataFrame

    def without_dates(self) -> "Filters":
        return replace(self, start=None, end=None)

    @property
    def has_range(self) -> bool:
        # the analysed dashboard applies a range only when both ends are set
        return self.start is not None and self.end is not None


def ts_bound(v) -> Column:
    """A bound as a zone-less timestamp column ('YYYY-MM-DD' means midnight)."""
    if isinstance(v, Column):
        return v.cast("timestamp_ntz")
    if isinstance(v, dt.datetime):
        v = v.isoformat(sep=" ")
    elif isinstance(v, dt.date):
        v = v.isoformat()
    return F.lit(str(v)).cast("timestamp_ntz")


def in_range(ts: str | Column, start, end) -> Column:
    """inclusive BETWEEN on timestamps."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c.between(ts_bound(start), ts_bound(end))


def country_is(country: str, col: str = "country") -> Column:
    """equality with a bound literal (never spliced into SQL text)."""
    return F.col(col) == F.lit(country)


def known_country(col: str = "country") -> Column:
    """country present and not 'Unspecified'."""
    return F.col(col).isNotNull() & (F.col(col) != F.lit(UNSPECIFIED_COUNTRY))


def non_blank(col: str) -> Column:
    """value present and not the empty string."""
    return F.col(col).isNotNull() & (F.col(col) != F.lit(""))


def positive(col: str = "net_revenue") -> Column:
    """Strictly positive measure."""
    return F.col(col) > 0


def non_product(col: str = "StockCode", codes=NON_PRODUCT_CODES) -> Column:
    """fee / adjustment codes (negate for real products)."""
    return F.col(col).isin(list(codes))


def known_customer(col: str = "CustomerID") -> Column:
    """customer key is not the placeholder."""
    return F.col(col) != F.lit(UNKNOWN_CUSTOMER)


def product_filter(df: DataFrame, products, col: str = "description") -> DataFrame:
    """keep lines whose product is in ``products``.

    A short Python list becomes an IN list, which the scan can use. A list of
    over ``LONG_LIST`` values becomes a table: the plan holds its size and not
    its values. A table, given or made, is joined by a left semi join, which is
    broadcast only if its measured size is small. NULL is in no list.
    """
    if not isinstance(products, DataFrame):
        products = list(products)
        if len(products) <= LONG_LIST:
            return df.filter(F.col(col).isin(products))
        spark = df.sparkSession
        kind = df.schema[col].dataType
        table = spark.createDataFrame([(p,) for p in set(products) if p is not None], T.StructType([T.StructField(col, kind)]))
        # lists are typed by hand or picked: rows of one driver partition, spread before the join
        products = table.repartition(spark.sparkContext.defaultParallelism, col)
    named = products.select(F.col(products.columns[0]).alias("_product")).distinct()
    return df.join(named, df[col] == named["_product"], "left_semi")


LONG_LIST = 1000  # values of an IN list
MONTH_PARTITION = "invoice_month"  # layout column of a month-partitioned table


def prune_months(df: DataFrame, start, end) -> DataFrame:
    """On a month-partitioned table, add the month predicate implied by a
    time range, which may be open (None) at an end (directory pruning);
    otherwise a no-op."""
    if MONTH_PARTITION not in df.columns:
        return df
    month = F.col(MONTH_PARTITION)
    if start is not None:
        df = df.filter(month >= F.trunc(F.to_date(ts_bound(start)), "month"))
    if end is not None:
        df = df.filter(month <= F.trunc(F.to_date(ts_bound(end)), "month"))
    return df


def apply_filters(df: DataFrame, f: Filters | None, ts: str = "invoicedate", country: str = "country",
                  product: str = "description", dates: bool = True) -> DataFrame:
    if f is None:
        return df
    if f.country is not None:
        df = df.filter(country_is(f.country, country))
    if dates and f.has_range:
        df = prune_months(df, f.start, f.end).filter(in_range(ts, f.start, f.end))
    if f.products is not None:
        df = product_filter(df, f.products, product)
    return df


def data_bounds(df: DataFrame, ts: str = "invoicedate") -> tuple[Column, Column]:
    """(min, max) of ``ts`` as scalar-subquery columns."""
    return df.select(F.min(ts)).scalar(), df.select(F.max(ts)).scalar()


def quick_range(df: DataFrame, option: str, ts: str = "invoicedate", resolve: bool = True):
    """('30d' | 'quarter' | 'year' | 'all') window ending at the latest line.

    resolve=True (default) runs one bounded aggregate (a single row: min and
    max of ``ts``) and returns literal bounds, as the dashboard does once at
    startup. Literal bounds reach the Parquet scan as pushed filters
    (row-group / partition skipping); resolve=False returns lazy
    scalar-subquery columns instead, which filter only after the scan.
    """
    if resolve:
        b = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
        if b is None or b.hi is None:
            return None, None
        if option in QUICK_RANGE_DAYS:
            return b.hi - dt.timedelta(days=QUICK_RANGE_DAYS[option]), b.hi
        return b.lo, b.hi
    lo, hi = data_bounds(df, ts)
    if option in QUICK_RANGE_DAYS:
        return shift_days(hi, -QUICK_RANGE_DAYS[option]), hi
    return lo, hi


def quick_filters(df: DataFrame, option: str, country: str | None = None, products=None,
                  ts: str = "invoicedate", resolve: bool = True) -> Filters:
    start, end = quick_range(df, option, ts, resolve)
    return Filters(country=country, start=start, end=end, products=products)


def previous_period(start, end) -> tuple[Column, Column, Column]:
    """F16: (days, prev_start, prev_end).

    days = whole days from start to end; the previous window is
    [start - days, start - 1 day], one day shorter than the current one.
    """
    s, e = ts_bound(start), ts_bound(end)
    days = whole_days_between(s, e)
    return days, shift_days(s, -days), shift_days(s, -1)


def quick_ranges(df: DataFrame, ts: str = "invoicedate") -> DataFrame:
    """F15 for every option at once: one row per option with its bounds."""
    lo, hi = F.min(ts), F.max(ts)
    rows = []
    for opt, days in list(QUICK_RANGE_DAYS.items()) + [("all", None)]:
        start = lo if days is None else shift_days(hi, -days)
        rows.append(F.struct(F.lit(opt).alias("option"), start.alias("start_date"), hi.alias("end_date")))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
