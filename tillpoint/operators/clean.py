"""Cleaning chain: raw invoice lines -> cleaned lines -> ``sales_data`` rows.

Order follows the analysed pipeline: fill missing keys, coerce types, drop
exact duplicate lines, split sales from returns, drop negative prices, derive
price flags and revenue measures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    free_flag,
    line_net_revenue,
    line_revenue,
    line_total_items,
    paid_price,
    return_qty,
    sale_qty,
)
from ..schema import RAW_SCHEMA, UNKNOWN_CUSTOMER, UNKNOWN_PRODUCT

SALES_KEY = ("invoiceno", "stockcode", "customerid")
LINE_KEY = ("InvoiceNo", "StockCode", "CustomerID")  # the same key, source-file names
LINE_ORDER = ["Description", "Quantity", "InvoiceDate", "UnitPrice", "Country"]  # the first line of a key is the least by these


def fill_missing(df: DataFrame, description: str = UNKNOWN_PRODUCT,
                 customer: str = UNKNOWN_CUSTOMER) -> DataFrame:
    """Missing Description / CustomerID get placeholder values."""
    return df.fillna({"Description": description, "CustomerID": customer})


def coerce_types(df: DataFrame, schema=RAW_SCHEMA) -> DataFrame:
    """Cast every raw column to its declared type (ANSI: bad text raises)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def parse_timestamp(df: DataFrame, column: str = "InvoiceDate", fmt: str | None = None) -> DataFrame:
    """Parse a text timestamp into a zone-less timestamp."""
    c = F.col(column)
    parsed = F.to_timestamp_ntz(c, F.lit(fmt)) if fmt else F.to_timestamp_ntz(c)
    return df.withColumn(column, parsed)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-line dedup (NULLs compare equal).

    A partial (map-side) dedup, a shuffle on all columns, a final dedup. A group
    of identical copies, however large, is reduced to one line per task before
    the shuffle.
    """
    return df.dropDuplicates()


def split_quantity(df: DataFrame) -> DataFrame:
    """Return_Qty / Sale_Qty from the signed quantity."""
    return df.withColumns({"Return_Qty": return_qty("Quantity"), "Sale_Qty": sale_qty("Quantity")})


def drop_invalid_prices(df: DataFrame, column: str = "UnitPrice") -> DataFrame:
    """keep lines with a price >= 0 (a missing price is dropped too)."""
    return df.filter(F.col(column) >= 0)


def price_columns(df: DataFrame) -> DataFrame:
    """Paid_UnitPrice and the Is_Free_Item flag."""
    return df.withColumns({"Paid_UnitPrice": paid_price("UnitPrice"), "Is_Free_Item": free_flag("UnitPrice")})


def revenue_columns(df: DataFrame) -> DataFrame:
    """Revenue, Net_Revenue, Total_Items (exact decimal arithmetic)."""
    return df.withColumns({
        "Revenue": line_revenue(),
        "Net_Revenue": line_net_revenue(),
        "Total_Items": line_total_items(),
    })


def handle_quantity_and_price(df: DataFrame) -> DataFrame:
    return price_columns(drop_invalid_prices(split_quantity(df)))


def distinct_lines(raw: DataFrame) -> DataFrame:
    """Raw lines -> filled and typed lines, each once."""
    return drop_exact_duplicates(coerce_types(fill_missing(raw)))


def clean_distinct(lines: DataFrame) -> DataFrame:
    """``distinct_lines`` -> cleaned lines."""
    return revenue_columns(handle_quantity_and_price(lines))


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Raw lines -> cleaned lines (raw columns + 7 derived columns)."""
    return clean_distinct(distinct_lines(raw))


def customer_domain(raw: DataFrame) -> DataFrame:
    """Every customer key seen before any line is dropped (after filling).

    The analysed pipeline fixes its customer categories at that point, so a
    customer whose every line is later removed still gets a summary row.
    """
    return fill_missing(raw).select("CustomerID").distinct()


def lowercase_columns(df: DataFrame) -> DataFrame:
    """P10: all column names in lower case."""
    return df.toDF(*[c.lower() for c in df.columns])


def dedup_keys(df: DataFrame, keys=SALES_KEY, order: list[str] | None = None) -> DataFrame:
    """One line per key, keeping the first by the remaining columns.

    The first line is ``min(struct(order...))`` per key: an aggregate, so it is
    combined map-side before the shuffle and a hot key never gathers all of
    its lines in one task (a ranking window would). NULLs sort first.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order else rest
    tail = [c for c in rest if c not in order]
    first = F.min(F.struct(*[F.col(c) for c in order + tail])).alias("_first")
    picked = df.groupBy(*keys).agg(first)
    return picked.select(*[F.col(k) for k in keys], *[F.col(f"_first.{c}").alias(c) for c in order + tail]) \
        .select(*df.columns)


FILE_ORDER = "_file_order"


def with_file_order(scan: DataFrame) -> DataFrame:
    """``scan`` (as a reader returns it, CSV or Parquet) with the place of each
    line in the input: file, block of the file, line within the block. Files
    stand by their paths, as a number: a path would go with every line through
    the shuffle. A task reads a block from its start, so the counter rises along
    the block whichever task reads it, and again if it is lost."""
    path = F.col("_metadata.file_path")
    here = scan.select("*", path.alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
    # a row for each file that has lines
    files = scan.select(path.alias("_path")).distinct().withColumn("_file", F.row_number().over(Window.orderBy("_path")))
    place = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_line").alias("line"))
    return here.join(F.broadcast(files), "_path").select(*scan.columns, place.alias(FILE_ORDER))


def dedup_keys_in_file_order(df: DataFrame, keys=SALES_KEY) -> DataFrame:
    """D2 as a run over the file does it: of each key the first line in the input
    stays. ``df`` comes from ``with_file_order`` by steps that keep its column
    and lines; the result has not the column. Combined map-side as ``dedup_keys``."""
    return dedup_keys(df, keys, [FILE_ORDER]).drop(FILE_ORDER)


def sales_from_raw(raw: DataFrame) -> DataFrame:
    """``to_sales_table(clean_transactions(raw))`` in one shuffle.

    The key dedup keeps, per key, the smallest remaining-column tuple; exact
    duplicate lines share both key and tuple, so removing them first cannot
    change which line survives. Skipping that step leaves a single
    aggregate, combined map-side (safe for hot keys and for huge groups of
    copies). The derived columns follow from the quantity and the price, so they
    decide no tie: they are made of the lines that stay, and no sort or shuffle
    carries them.
    """
    priced = drop_invalid_prices(coerce_types(fill_missing(raw)))
    first = dedup_keys(lowercase_columns(priced), SALES_KEY, [c.lower() for c in LINE_ORDER]).toDF(*priced.columns)
    return _table_types(revenue_columns(price_columns(split_quantity(first))))


def to_sales_table(clean: DataFrame) -> DataFrame:
    """Cleaned lines -> ``sales_data`` rows: lower-case names, one line per
    (invoice, stock code, customer), table column types."""
    return _table_types(dedup_keys(lowercase_columns(clean), SALES_KEY, [c.lower() for c in LINE_ORDER]))


def _table_types(lines: DataFrame) -> DataFrame:
    from ..sources.tables import conform
    from ..schema import SALES_SCHEMA

    return conform(lines, SALES_SCHEMA)
