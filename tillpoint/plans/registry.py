"""Registered queries: name -> f(spark, sf_dir) -> DataFrame.

Names are ``<survey id>_<short name>``. Each builds its input from the
driver's tables (all rows) and applies one operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import composite_key, label30, ratio
from ..operators import clean as C
from ..operators import customers, kpi, products, quality, rankings, rollup, trends
from ..operators.filters import Filters, apply_filters, previous_period, quick_filters, quick_ranges
from ..schema import RAW_SCHEMA
from ..session import scratch_path
from ..sources import checked, readers, sinks, statistics, versions
from ..sources.tables import run_sql
from . import inputs

Query = Callable[[SparkSession, str], DataFrame]
Operator = Callable[[object], DataFrame]
QUERIES: dict[str, Query] = {}  # (spark, sf_dir) -> DataFrame, inputs derived from the sf folder
OPERATORS: dict[str, Operator] = {}  # (inputs provider) -> DataFrame

# Parameters of the registered queries (what a user would pick).
COUNTRY = "United Kingdom"
EXPORT_START, EXPORT_END = "1998-01-01", "1999-12-31"
PRODUCTS = ("blue anvil", "hot rod", "small widget")
LONG_LIST = range(0, 200_000, 2)  # stock codes, as text
DAYS = Filters(start="1998-01-01", end="1998-12-31")  # bounds at midnight: the rollup answers
QUICK = "year"
NOW = "2026-01-01 00:00:00"
RUN_ID = "20260101_000000"


def register(name: str):
    def deco(fn: Operator) -> Operator:
        OPERATORS[name] = fn

        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(inputs.FixtureInputs(spark, sf_dir))

        query.__name__ = query.__qualname__ = name
        QUERIES[name] = query
        return fn
    return deco


def _dedup(src):
    return C.drop_exact_duplicates(C.coerce_types(C.fill_missing(src.raw)))


# --- sources / sinks ------------------------------------------------------------

@register("sk1_raw_transactions")
def _sk1(src):
    return src.raw


@register("sk1_csv_read")
def _sk1c(src):
    path = scratch_path(src.spark, "raw-csv")
    sinks.write_csv(src.raw, path)
    return readers.read_transactions(src.spark, path)


@register("sk1_load_report")
def _sk1r(src):
    """Raw lines of which some have a quantity, a time or a price that is none, or
    a field too many, written as text and read back."""
    line, text = F.col("InvoiceNo").cast("bigint"), {f.name: F.col(f.name).cast("string") for f in RAW_SCHEMA.fields}
    text |= {"Quantity": F.when(line % 97 == 1, F.lit("many")).otherwise(text["Quantity"]),
             "InvoiceDate": F.when(line % 89 < 2, F.lit("yesterday")).otherwise(F.date_format("InvoiceDate", "yyyy-MM-dd'T'HH:mm:ss")),
             "UnitPrice": F.when(line % 97 < 2, F.lit("dear")).otherwise(text["UnitPrice"])}
    path = scratch_path(src.spark, "raw-faulty")
    quoted = [F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"')) for c in text.values()]
    fields = F.concat_ws(",", *quoted, F.when(line % 83 == 5, F.lit("more")))
    src.raw.select(fields).write.option("lineSep", "\n").text(path)
    return checked.fault_counts(checked.read_checked(src.spark, path, header=False))


@register("sk2_cleaned_csv")
def _sk2(src):
    path = scratch_path(src.spark, "out")
    once = src.written
    paths = sinks.save_results(once.clean, once.summary, path)
    return readers.load_csv_data(src.spark, paths["cleaned"], paths["customer_summary"])[0]


@register("sk4_load_counts")
def _sk4(src):
    path = scratch_path(src.spark, "loads")
    parts = {"even": F.col("invoiceno").cast("bigint") % 2 == 0, "odd": F.col("invoiceno").cast("bigint") % 2 == 1}
    for load in ("even", "odd", "odd"):  # the same load twice
        versions.append_load(src.sales.where(parts[load]), path, load)
    return versions.load_counts(src.spark, path)


@register("sk5_replaced_table")
def _sk5(src):
    path = scratch_path(src.spark, "replaced")
    versions.replace_version(src.sales, path)
    versions.replace_version(versions.read_version(src.spark, path).where("net_revenue > 0"), path)  # from itself
    return versions.read_version(src.spark, path)


@register("sk3_sales_table")
def _sk3(src):
    return src.sales


@register("sk3_summary_table")
def _sk3s(src):
    return src.summary_table


@register("sk3_key_check")
def _sk3k(src):
    return quality.unique_check(src.summary_table)


@register("sk6_sql_top_countries")
def _sk6(src):
    sql = """
        SELECT country, CAST(SUM(net_revenue) AS DECIMAL(38,2)) AS revenue
        FROM sales_data
        WHERE net_revenue > 0 AND country IS NOT NULL AND country <> :excluded
        GROUP BY country
        ORDER BY revenue DESC, country
        LIMIT 8"""
    return run_sql(src.spark, sql, {"excluded": "Unspecified"}, tables={"sales_data": src.sales})


@register("sk9_export_rows")
def _sk9(src):
    return sinks.export_rows(src.sales, Filters(COUNTRY, EXPORT_START, EXPORT_END))


@register("sk9_export_files")
def _sk9f(src):
    spark = src.spark
    path = sinks.export_files(src.sales, Filters(COUNTRY, EXPORT_START, EXPORT_END), scratch_path(spark, "export"), max_lines=500)
    lines = sinks.read_export(spark, path, sinks.export_rows(src.sales, Filters()).schema)
    here = F.row_number().over(Window.partitionBy("file").orderBy("line"))  # a file has 500 lines at most
    first = sinks.read_manifest(spark, path).select("file", "first_line")
    return lines.withColumn("here", here).join(first, "file").withColumn("position", F.col("first_line") + F.col("here")).drop("file", "line", "here", "first_line")


# --- projections ----------------------------------------------------------------

@register("p1_fill_missing")
def _p1(src):
    return C.fill_missing(src.raw)


@register("p2_p3_text_load")
def _p23(src):
    text = src.raw.select(*[F.col(c).cast("string").alias(c) for c in src.raw.columns])
    return C.coerce_types(C.parse_timestamp(text))


@register("p_clean_transactions")
def _clean(src):
    return src.clean


@register("p10_lowercase_columns")
def _p10(src):
    return C.lowercase_columns(src.clean)


@register("p11_composite_keys")
def _p11(src):
    s = src.sales
    return s.select("invoiceno", "stockcode", "customerid",
                    composite_key("invoiceno", "stockcode", "customerid").alias("line_key"))


@register("p12_product_labels")
def _p12(src):
    s = src.sales
    return s.select("description", label30("description").alias("label")).distinct()


# --- filters ----------------------------------------------------------------------

@register("f2_country_lines")
def _f2(src):
    from ..operators.filters import apply_filters

    return apply_filters(src.sales, Filters(country=COUNTRY))


@register("f3_date_range_lines")
def _f3(src):
    from ..operators.filters import apply_filters

    return apply_filters(src.sales, Filters(start=EXPORT_START, end=EXPORT_END))


@register("f6_known_country_lines")
def _f6(src):
    from ..operators.filters import known_country

    return src.sales.filter(known_country("country"))


@register("f7_nonblank_country_lines")
def _f7(src):
    from ..operators.filters import non_blank

    return src.sales.filter(non_blank("country"))


@register("f8_positive_revenue_lines")
def _f8(src):
    from ..operators.filters import positive

    return src.sales.filter(positive("net_revenue"))


@register("f9_lines_with_items")
def _f9(src):
    from ..operators.filters import positive

    return src.sales.filter(positive("total_items"))


@register("f10_lines_with_sales")
def _f10(src):
    from ..operators.filters import positive

    return src.sales.filter(positive("sale_qty"))


@register("f14_positive_customers")
def _f14(src):
    from ..operators.filters import positive

    return src.summary_table.filter(positive("total_net_revenue"))


@register("p13_formatted_metrics")
def _p13(src):
    from ..functions.format import format_value

    one = kpi.financial_summary(src.sales)
    rows = [("total_net_revenue", F.col("total_net_revenue"), "currency"),
            ("unique_products", F.col("unique_products"), "count"),
            ("return_pct", ratio(F.col("total_items_returned") * 100, "total_items_sold"), "percent"),
            ("revenue_per_customer", ratio("total_net_revenue", "unique_customers"), "other")]
    long = one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value"), F.lit(f).alias("format"))
        for n, v, f in rows])))
    return long.withColumn("display", format_value("value", F.col("format")))


@register("f4_selected_product_lines")
def _f4(src):
    from ..operators.filters import apply_filters

    return apply_filters(src.sales, Filters(products=PRODUCTS))


@register("f4_long_code_list")
def _f4l(src):
    return apply_filters(src.sales, Filters(products=[str(k) for k in LONG_LIST]), product="stockcode")


@register("f11_non_product_lines")
def _f11(src):
    from ..operators.filters import non_product

    return src.clean.filter(non_product("StockCode"))


@register("f12_code_lookup")
def _f12(src):
    return products.code_lookup(src.clean, "M")


@register("f15_quick_ranges")
def _f15(src):
    return quick_ranges(src.sales)


@register("f16_previous_periods")
def _f16(src):
    r = quick_ranges(src.sales)
    days, ps, pe = previous_period(F.col("start_date"), F.col("end_date"))
    return r.select("option", days.alias("days"), ps.alias("prev_start"), pe.alias("prev_end"))


# --- dedup and quality -------------------------------------------------------------

@register("d1_exact_dedup")
def _d1(src):
    return _dedup(src)


@register("d2_key_dedup")
def _d2(src):
    return C.dedup_keys(C.lowercase_columns(src.clean), C.SALES_KEY,
                        ["description", "quantity", "invoicedate", "unitprice", "country"])


@register("d2_first_in_file")
def _d2f(src):
    """Cleaned lines in files whose order is the reverse of the values' order."""
    lines = C.lowercase_columns(src.clean)
    path = scratch_path(src.spark, "in-file-order")
    order = [F.col(c).desc_nulls_last() for c in ("description", "quantity", "invoicedate", "unitprice", "country", *C.SALES_KEY)]
    lines.orderBy(*order).write.parquet(path)
    return C.dedup_keys_in_file_order(C.with_file_order(src.spark.read.schema(lines.schema).parquet(path)))


@register("d3_duplicate_profile")
def _d3(src):
    return quality.duplicate_profile(C.fill_missing(src.raw))


@register("d4_duplicate_rows")
def _d4(src):
    return quality.duplicate_rows(C.fill_missing(src.raw))


@register("d4_duplicate_sample")
def _d4s(src):
    return quality.duplicate_rows(C.fill_missing(src.raw), sample=10)


@register("d5_top_duplicated_products")
def _d5p(src):
    return quality.top_duplicated(C.fill_missing(src.raw), "StockCode")


@register("d5_top_duplicated_invoices")
def _d5i(src):
    return quality.top_duplicated(C.fill_missing(src.raw), "InvoiceNo")


@register("d6_missing_raw")
def _d6r(src):
    return quality.missing_profile(src.raw)


@register("d6_missing_filled")
def _d6f(src):
    return quality.missing_profile(C.fill_missing(src.raw))


@register("d7_date_checks")
def _d7(src):
    return quality.date_checks(_dedup(src), NOW)


@register("d7_table_date_checks")
def _d7t(src):
    return statistics.table_date_checks(src.spark, src.tables.path("sales_data"), NOW)


@register("d8_value_checks")
def _d8(src):
    return quality.value_checks(_dedup(src))


@register("d9_unit_totals")
def _d9(src):
    return quality.unit_totals(C.split_quantity(_dedup(src)))


@register("d10_price_filter_profile")
def _d10(src):
    return quality.price_filter_profile(_dedup(src))


@register("d11_paid_free_counts")
def _d11(src):
    return quality.paid_free_counts(src.clean)


@register("d12_shape")
def _d12(src):
    return quality.shape(src.clean)


@register("d13_key_check")
def _d13(src):
    return quality.key_check(src.sales)


@register("d14_load_check")
def _d14(src):
    return quality.load_check(src.sales, src.summary_table)


# --- products -----------------------------------------------------------------------

@register("a1_product_revenue")
def _a1(src):
    return products.product_revenue(src.clean)


@register("a1_worst_products")
def _a1w(src):
    return products.worst_products(src.clean, 20)


@register("a3_non_product_revenue")
def _a3(src):
    return products.non_product_revenue(src.clean)


@register("a4_top_profitable")
def _a4p(src):
    return products.analyze_products(src.clean).top_profitable


@register("a4_top_losses")
def _a4l(src):
    return products.analyze_products(src.clean).top_losses


@register("a4_top_losses_script_order")
def _a4s(src):
    return products.analyze_products(src.clean, losses="script").top_losses


@register("a4_product_counts")
def _a4c(src):
    return products.analyze_products(src.clean).counts


# --- customers -----------------------------------------------------------------------

@register("a2_customer_revenue")
def _a2(src):
    return customers.customer_revenue(src.clean, src.domain)


@register("a5_purchases_per_customer")
def _a5(src):
    return customers.purchases_per_customer(src.clean, src.domain)


@register("a6_customer_base")
def _a6(src):
    return customers.customer_base(src.clean, src.domain)


@register("a12_customer_summary")
def _a12(src):
    return customers.customer_summary(src.clean, src.domain)


@register("a29_rfm_base")
def _a29(src):
    return customers.rfm_base(src.sales)


@register("a30_quartile_segments")
def _a30(src):
    return customers.quartile_segments(customers.rfm_base(src.sales))


@register("a39_spend_segments")
def _a39(src):
    return customers.spend_segments(src.summary_table)


# --- KPIs -------------------------------------------------------------------------------

@register("a13_pipeline_summary")
def _a13(src):
    c = src.clean
    return kpi.pipeline_summary(c, src.summary, products.analyze_products(c).counts)


@register("a14_date_bounds")
def _a14(src):
    return kpi.date_bounds(src.sales)


@register("a14_footer_bounds")
def _a14f(src):
    return statistics.footer_bounds(src.spark, src.tables.path("sales_data"))


@register("a15_data_period")
def _a15(src):
    return kpi.data_period(src.sales).drop("data_period")


@register("a16_countries")
def _a16c(src):
    return kpi.distinct_values(src.sales, "country")


@register("a16_products")
def _a16p(src):
    return kpi.distinct_values(src.sales, "description")


@register("a17_kpi_block")
def _a17(src):
    s = src.sales
    return kpi.kpi_block(s, quick_filters(s, QUICK))


@register("a17_kpi_block_all_dates")
def _a17a(src):
    return kpi.kpi_block(src.sales, Filters())


@register("a20_kpi_cards")
def _a20(src):
    s = src.sales
    return kpi.kpi_cards(kpi.kpi_block(s, quick_filters(s, QUICK)))


@register("a38_financial_summary")
def _a38(src):
    return kpi.financial_summary(src.sales)


@register("a40_report_kpis")
def _a40(src):
    return kpi.report_kpis(src.sales, RUN_ID)


@register("a41_notebook_kpis")
def _a41(src):
    return kpi.notebook_kpis(src.sales)


# --- trends ----------------------------------------------------------------------------------

@register("a21_monthly_yoy")
def _a21y(src):
    s = src.sales
    return trends.monthly_comparison(s, quick_filters(s, QUICK), "yoy")


@register("a21_monthly_prev")
def _a21p(src):
    s = src.sales
    return trends.monthly_comparison(s, quick_filters(s, QUICK), "prev")


@register("a22_monthly_revenue")
def _a22(src):
    return trends.monthly_revenue(src.sales)


@register("a23_monthly_positive")
def _a23(src):
    return trends.monthly_positive_revenue(src.sales)


@register("a24_monthly_sales")
def _a24(src):
    return trends.monthly_sales(src.sales)


@register("a25_peak_month")
def _a25(src):
    return trends.peak_month(trends.monthly_sales(src.sales))


@register("a26_sales_by_weekday")
def _a26(src):
    return trends.sales_by_weekday(src.sales)


@register("a27_hour_weekday_revenue")
def _a27(src):
    return trends.hour_weekday_revenue(src.sales)


@register("a28_hour_weekday_heatmap")
def _a28(src):
    return trends.hour_weekday_heatmap(src.sales)


# --- the same from the daily rollup ---------------------------------------------------------

@register("a17_rollup_kpis")
def _a17r(src):
    return rollup.rollup_kpi_block(src.hours, src.customer_days, DAYS)


@register("a21_rollup_yoy")
def _a21r(src):
    return rollup.rollup_comparison(src.hours, DAYS, "yoy")


@register("a22_rollup_monthly")
def _a22r(src):
    return rollup.rollup_monthly(src.hours)


@register("a24_rollup_monthly_sales")
def _a24r(src):
    return rollup.rollup_monthly_sales(src.hours)


@register("a26_rollup_weekday")
def _a26r(src):
    return rollup.rollup_weekday(src.hours, DAYS)


@register("a27_rollup_hours")
def _a27r(src):
    return rollup.rollup_hours(src.hours, DAYS)


@register("a28_rollup_heatmap")
def _a28r(src):
    return rollup.rollup_heatmap(src.hours)


# --- rankings --------------------------------------------------------------------------------

@register("a31_country_revenue")
def _a31(src):
    return rankings.country_revenue(src.sales)


@register("a32_top_products")
def _a32(src):
    return rankings.top_products(src.sales)


@register("a33_selected_products")
def _a33(src):
    return rankings.selected_products(src.sales, PRODUCTS)


@register("a34_top_products_by_volume")
def _a34(src):
    return rankings.top_products_by_volume(src.sales)


@register("a35_top_countries_positive")
def _a35(src):
    return rankings.top_countries(src.sales, positive_only=True)


@register("a36_top_countries_all")
def _a36(src):
    return rankings.top_countries(src.sales, positive_only=False)


@register("a37_countries_by_lines")
def _a37(src):
    return rankings.countries_by_lines(src.sales)

