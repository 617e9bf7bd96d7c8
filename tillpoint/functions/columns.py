"""Reusable column expressions: derived measures, calendar parts, keys, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import AMOUNT, FREE_NO, FREE_YES, PRICE

__all__ = [
    "col_or_name",
    "return_qty",
    "sale_qty",
    "paid_price",
    "free_flag",
    "line_revenue",
    "line_net_revenue",
    "line_total_items",
    "composite_key",
    "label30",
    "weekday0",
    "weekday_abbr",
    "month_start",
    "whole_days_between",
    "ratio",
    "safe_ratio",
    "money_sum",
    "int_sum",
    "mean",
    "shift_days",
]


def col_or_name(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- quantity / price split (sales vs returns, paid vs free) ---------------

def return_qty(q="Quantity") -> Column:
    """Returned units: |q| for negative quantities, else 0."""
    q = col_or_name(q)
    return F.when(q < 0, -q).otherwise(F.lit(0)).cast("int")


def sale_qty(q="Quantity") -> Column:
    """Sold units: q for positive quantities, else 0."""
    q = col_or_name(q)
    return F.when(q > 0, q).otherwise(F.lit(0)).cast("int")


def paid_price(p="UnitPrice", dtype=PRICE) -> Column:
    """Price that earns revenue: the price when positive, else 0."""
    p = col_or_name(p)
    return F.when(p > 0, p).otherwise(F.lit(0)).cast(dtype)


def free_flag(p="UnitPrice") -> Column:
    p = col_or_name(p)
    return F.when(p == 0, F.lit(FREE_YES)).otherwise(F.lit(FREE_NO))


def line_revenue(sale="Sale_Qty", paid="Paid_UnitPrice", dtype=AMOUNT) -> Column:
    return (col_or_name(sale) * col_or_name(paid)).cast(dtype)


def line_net_revenue(sale="Sale_Qty", ret="Return_Qty", paid="Paid_UnitPrice", dtype=AMOUNT) -> Column:
    return ((col_or_name(sale) - col_or_name(ret)) * col_or_name(paid)).cast(dtype)


def line_total_items(sale="Sale_Qty", ret="Return_Qty") -> Column:
    return (col_or_name(sale) + col_or_name(ret)).cast("int")


# --- keys and labels -------------------------------------------------------

def composite_key(*cols, sep: str = "-") -> Column:
    """``a-b-c`` key; NULL if any part is NULL (SQL concatenation semantics)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(col_or_name(c))
    return F.concat(*parts)


def label30(c="description") -> Column:
    """Display label: the first 30 characters."""
    return F.substring(col_or_name(c), 1, 30)


# --- calendar --------------------------------------------------------------

def weekday0(ts="invoicedate") -> Column:
    """Day of week numbered 0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(col_or_name(ts)) - 1).cast("int")


def weekday_abbr(ts="invoicedate") -> Column:
    """Three-letter English day name ('Sun' .. 'Sat')."""
    return F.date_format(col_or_name(ts), "EEE")


def month_start(ts="invoicedate") -> Column:
    """First instant of the month as a zone-less timestamp.

    Truncates the calendar date and casts it back: no step goes through the
    session time zone (``date_trunc`` on a timestamp would).
    """
    return F.trunc(F.to_date(col_or_name(ts)), "month").cast("timestamp_ntz")


def whole_days_between(start, end) -> Column:
    """Whole 24-hour periods from ``start`` to ``end`` (not calendar-day crossings).

    Taken from the zone-less day-time interval ``end - start``, so the count
    never depends on the session time zone (no daylight-saving hours).
    """
    s = col_or_name(start).cast("timestamp_ntz")
    e = col_or_name(end).cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), e - s).cast("bigint")


def shift_days(ts, days) -> Column:
    """``ts`` moved by ``days`` (int column or literal) whole days."""
    d = days if isinstance(days, Column) else F.lit(int(days))
    return F.timestamp_add("DAY", d, col_or_name(ts))


# --- aggregates with engine-independent result types -----------------------

def ratio(num, den) -> Column:
    """num / den in double precision; NULL when den is NULL or 0."""
    return col_or_name(num).cast("double") / F.nullif(col_or_name(den), F.lit(0)).cast("double")


def safe_ratio(num, den, default: float = 0.0) -> Column:
    """num / den, or ``default`` when den is not positive."""
    d = col_or_name(den)
    return F.when(d > 0, col_or_name(num).cast("double") / d.cast("double")).otherwise(F.lit(float(default)))


def money_sum(c, dtype="decimal(38,4)") -> Column:
    """Exact decimal sum with a fixed result type."""
    return F.sum(col_or_name(c)).cast(dtype)


def int_sum(c) -> Column:
    return F.sum(col_or_name(c)).cast("bigint")


def mean(c, where: Column | None = None) -> Column:
    """Arithmetic mean as double: sum / count (NULL for an empty group).

    Written as a ratio of exact sums so that every engine returns the same
    double for decimal inputs.
    """
    x = col_or_name(c)
    if where is not None:
        x = F.when(where, x)
    return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0)).cast("double")
