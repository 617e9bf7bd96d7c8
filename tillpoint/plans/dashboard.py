"""The dashboard's panels for one filter selection.

Each panel is a lazy DataFrame over the ``sales_data`` table. Where the
analysed dashboard issues several queries per panel, these are one scan:
the KPI block computes current and previous windows together.
"""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators import customers, kpi, rankings, trends
from ..operators import rollup as R
from ..operators.filters import Filters, apply_filters
from ..schema import QUICK_RANGE_DAYS
from ..sources.statistics import table_bounds


def table_quick_filters(spark: SparkSession, path: str, option: str, country: str | None = None, products=None) -> Filters:
    """F15 for a table: its bounds come from the files' footers, not from its lines."""
    lo, hi = table_bounds(spark, path)
    start = lo if option not in QUICK_RANGE_DAYS or hi is None else hi - dt.timedelta(days=QUICK_RANGE_DAYS[option])
    return Filters(country=country, start=start, end=hi, products=products)


def filter_domains(sales: DataFrame) -> dict[str, DataFrame]:
    """Startup lists: date bounds, countries, products."""
    return {"dates": kpi.date_bounds(sales),
            "countries": kpi.distinct_values(sales, "country"),
            "products": kpi.distinct_values(sales, "description")}


@contextmanager
def cached_slice(sales: DataFrame, country: str):
    """Persist one country's lines for a series of interactions on it.

    Every country-scoped panel (KPIs with the previous window, monthly series
    and comparison, weekday, heatmap, segments, products) then reads the
    cached slice instead of scanning the table. The slice is one country's
    lines only, and is released when the block ends.
    """
    part = apply_filters(sales, Filters(country=country)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield part
    finally:
        part.unpersist()


def panels(sales: DataFrame, f: Filters, compare: str = "none", country_lines: DataFrame | None = None,
           rollup: tuple[DataFrame, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All panels for one selection. ``country_lines``: a ``cached_slice`` of
    ``f.country`` to read the country-scoped panels from. ``rollup``: the tables
    (``sales_hours``, ``customer_days``), from which the KPI and time panels are
    read where they answer for ``f`` (bounds at midnight, all products)."""
    by = () if f.country is not None else ("country",)
    geo_source = sales
    if country_lines is not None and f.country is not None:
        sales = country_lines
    out = {
        # values and display cards from one aggregate
        "kpis": kpi.kpi_cards(kpi.kpi_block(sales, f, by), by, keep_values=True),
        "monthly": trends.monthly_comparison(sales, f, compare, by) if compare != "none" or f.has_range
        else trends.monthly_revenue(sales, f, by),
        "weekday": trends.sales_by_weekday(sales, f, by),
        "heatmap": trends.hour_weekday_heatmap(sales, f, by),
        "segments": customers.quartile_segments(customers.rfm_base(sales, f, by), by),
        "geography": rankings.country_revenue(geo_source, Filters(start=f.start, end=f.end)),
    }
    if rollup is not None and R.covers(f):
        hours, days = rollup
        out |= {
            "kpis": kpi.kpi_cards(R.rollup_kpi_block(hours, days, f, by), by, keep_values=True),
            "monthly": R.rollup_comparison(hours, f, compare, by) if compare != "none" or f.has_range else R.rollup_monthly(hours, f, by),
            "weekday": R.rollup_weekday(hours, f, by),
            "heatmap": R.rollup_heatmap(hours, f, by),
        }
    if f.products is not None:
        out["products"] = rankings.selected_products(sales, f.products, Filters(f.country, f.start, f.end), by)
    else:
        out["products"] = rankings.top_products(sales, f, 10, by)
    return out
