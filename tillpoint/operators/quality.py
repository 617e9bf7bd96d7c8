"""Data-quality profiles: duplicates, missing values, date / value sanity,
price-filter effect, post-load checks. Each profile is a single aggregate
pass (duplicate profiles: one shuffle on all columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import composite_key, int_sum, ratio
from ..schema import SUSPICIOUS_BEFORE
from .filters import ts_bound


def _groups(df: DataFrame) -> DataFrame:
    """Identical-line groups with their multiplicity (NULLs compare equal)."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """D3: total lines, duplicate lines (all but one per identical group),
    lines after dedup, removed percentage."""
    g = _groups(df)
    out = g.agg(int_sum("_n").alias("total_rows"),
                int_sum(F.col("_n") - 1).alias("duplicate_rows"),
                F.count(F.lit(1)).alias("unique_rows"))
    return out.withColumn("removed_pct", ratio(F.col("duplicate_rows") * 100, "total_rows"))


def duplicate_rows(df: DataFrame, sample: int | None = None, chunk: int = 100_000) -> DataFrame:
    """The redundant copies (n - 1 per identical group of n lines).

    Copies are regenerated from the group counts with ``explode(sequence)``:
    linear in the output, never pairs. A group of copies larger than
    ``chunk`` is first split into chunk descriptors spread over all shuffle
    partitions, so no single task regenerates a huge group. ``sample``
    returns the first lines in column order; as every group has a copy, they
    are found in the first ``sample`` groups, and only those are regenerated.
    """
    cols = df.columns
    order = [F.col(c).asc_nulls_first() for c in cols]
    g = _groups(df).filter(F.col("_n") > 1)
    if sample is not None:
        g = g.orderBy(*order).limit(sample)
    n = F.col("_n")
    pieces = g.select(*cols, n.alias("_n"),
                      F.explode(F.sequence(F.lit(0), F.floor((n - 2) / F.lit(chunk)).cast("long"))).alias("_chunk"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = pieces.repartition(parts, *[F.col(c) for c in cols], F.col("_chunk"))
    lo = F.lit(2) + F.col("_chunk") * F.lit(chunk)
    hi = F.least(F.col("_n"), lo + F.lit(chunk - 1))
    out = spread.select(*cols, F.explode(F.sequence(lo, hi)).alias("_copy")).select(*cols)
    if sample is not None:
        out = out.orderBy(*order).limit(sample)
    return out


def top_duplicated(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k values of ``col`` with the most redundant copies."""
    g = _groups(df).filter(F.col("_n") > 1).filter(F.col(col).isNotNull())
    return (g.groupBy(col).agg(int_sum(F.col("_n") - 1).alias("duplicates"))
            .orderBy(F.col("duplicates").desc(), F.col(col)).limit(k))


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count and percentage per column, long form, one pass."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(F.col(c).isNull()).alias(f"_m{i}")
                                                  for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                     F.col(f"_m{i}").alias("missing"),
                     ratio(F.col(f"_m{i}") * 100, "_rows").alias("missing_pct"))
            for i, c in enumerate(df.columns)]
    return one.select(F.inline(F.array(*rows)))


def date_checks(df: DataFrame, now, before=SUSPICIOUS_BEFORE, ts: str = "InvoiceDate") -> DataFrame:
    """Earliest / latest line, lines dated after ``now`` and before ``before``.

    ``now`` is a parameter (a fixed instant keeps reruns reproducible).
    """
    c = F.col(ts)
    return df.agg(F.min(c).alias("earliest"), F.max(c).alias("latest"),
                  F.count_if(c > ts_bound(now)).alias("future_dates"),
                  F.count_if(c < ts_bound(before)).alias("suspicious_dates"))


def value_checks(df: DataFrame, qty: str = "Quantity", price: str = "UnitPrice") -> DataFrame:
    """Negative / zero quantity and price line counts."""
    q, p = F.col(qty), F.col(price)
    return df.agg(F.count_if(q < 0).alias("negative_quantity"), F.count_if(q == 0).alias("zero_quantity"),
                  F.count_if(p < 0).alias("negative_price"), F.count_if(p == 0).alias("zero_price"))


def unit_totals(df: DataFrame) -> DataFrame:
    """Units sold and returned."""
    return df.agg(int_sum("Sale_Qty").alias("total_sold"), int_sum("Return_Qty").alias("total_returned"))


def price_filter_profile(df: DataFrame, price: str = "UnitPrice") -> DataFrame:
    """Lines before / after the price filter and lines dropped."""
    out = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(F.col(price) >= 0).alias("rows_after"))
    return out.withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def paid_free_counts(clean: DataFrame) -> DataFrame:
    """Paid lines (price > 0) and free lines."""
    return clean.agg(F.count_if(F.col("Paid_UnitPrice") > 0).alias("paid_items"),
                     F.count_if(F.col("Is_Free_Item") == "Yes").alias("free_items"))


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_types(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column names and types (schema metadata, not data)."""
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
                                 "position int, column_name string, data_type string")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n lines (no ordering guarantee, like a head())."""
    return df.limit(n)


def key_check(sales: DataFrame, keys=("invoiceno", "stockcode", "customerid")) -> DataFrame:
    """Total lines vs distinct composite keys (a key with a NULL part
    is not counted)."""
    return sales.agg(F.count(F.lit(1)).alias("total_rows"),
                     F.count_distinct(composite_key(*keys)).alias("unique_rows"))


def unique_check(table: DataFrame, key: str = "customerid") -> DataFrame:
    """SK3: rows, distinct keys, keys found more than once, rows without a
    key. A primary key holds when the last two are 0."""
    per_key = table.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = F.col(key).isNotNull()
    return per_key.agg(F.coalesce(int_sum("_n"), F.lit(0).cast("bigint")).alias("total_rows"),
                       F.count_if(known).alias("unique_keys"),
                       F.count_if(known & (F.col("_n") > 1)).alias("repeated_keys"),
                       F.coalesce(int_sum(F.when(~known, F.col("_n"))), F.lit(0).cast("bigint")).alias("null_keys"))


def load_check(sales: DataFrame, summary: DataFrame) -> DataFrame:
    """Lines in both tables and lines per customer (NULL if no customers)."""
    base = sales.agg(F.count(F.lit(1)).alias("sales_count"))
    out = base.withColumn("customer_count", summary.select(F.count(F.lit(1))).scalar())
    return out.withColumn("lines_per_customer", ratio("sales_count", "customer_count"))
