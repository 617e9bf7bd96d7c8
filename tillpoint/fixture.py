"""Test input: the driver's TPC-H-style tables mapped onto raw invoice lines.

The tables are far cleaner than retail data, so a deterministic rule set
injects the cases the operators exist for (missing keys, returns, free and
negative prices, non-product codes, blank / null / 'Unspecified' countries,
exact duplicate lines, intra-day times). Every input row is kept; the
duplicate rule only *adds* rows. The rules use integer arithmetic and CASE
only, so the same mapping is written once as DataFrame code (here) and once
as SQL text for the DuckDB oracle (``oracle_sql.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import PRICE, RAW_COLUMNS
from .session import path_bytes, shuffle_partitions_for

# Fixed values of the mapping (see FIXTURES.md §3).
FEE_CODES = {7: "AMAZONFEE", 11: "M", 13: "BANK CHARGES"}  # l_partkey % 200
DEFAULT_COUNTRY_KEY = 0  # -> 'United Kingdom'
BLANK_COUNTRY_KEY = 22  # -> ''
NULL_COUNTRY_KEY = 23  # -> NULL
UNSPECIFIED_COUNTRY_KEY = 24  # -> 'Unspecified'
LATE_ORDER_CUTOFF = "2001-07-25 00:00:00"
DUPLICATE_EVERY = 50  # orders whose key is a multiple get every line twice

JOIN_BYTES = 4 << 20  # of the lines' compressed files, for one task of the join
FEW = 8  # tasks up to which the session's settings do
MANY = 10_000  # tasks from which on each takes more
PART_BYTES = 20 << 20  # of part's files: up to that its three columns are Spark's to broadcast


def join_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of lines x orders. A task of it sorts both sides and, for the
    queries that combine lines before their shuffle, holds the joined lines too:
    ten times and more what was read, so it gets a few megabytes. (Of fewer
    partitions than ``spark.sql.shuffle.partitions`` Spark makes that many.)"""
    size = path_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return min(shuffle_partitions_for(size, JOIN_BYTES, FEW), max(MANY, shuffle_partitions_for(size)))


def _table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw invoice lines (``RAW_SCHEMA``) derived from one scale-factor folder."""
    lineitem = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
                      "l_quantity", "l_returnflag")
    orders = _table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    customer = _table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    part = _table(spark, sf_dir, "part", "p_partkey", "p_name", "p_retailprice")
    # nation has 25 rows by definition of the schema: a proven broadcast bound.
    nation = F.broadcast(_table(spark, sf_dir, "nation", "n_nationkey", "n_name"))

    buyers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    headers = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    # lines x orders is the large join (both grow with the data): a
    # sort-merge join on the order key (spills, never a broadcast of either
    # side). The shuffle also spreads the driver's single-row-group files
    # over all cores, in partitions whose number follows the lines' bytes.
    parts = join_partitions(spark, sf_dir)
    if parts > FEW:
        lineitem, headers = lineitem.repartition(parts, "l_orderkey"), headers.repartition(parts, "o_orderkey")
    lines = lineitem.join(headers.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    # a part too large to broadcast is a second shuffle of all lines, whose tasks
    # hold as much as those of the first: it gets as many.
    if parts > FEW and path_bytes(spark, f"{sf_dir.rstrip('/')}/part.parquet") > PART_BYTES:
        lines, part = lines.repartition(parts, "l_partkey"), part.repartition(parts, "p_partkey").hint("merge")
    lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))

    pk, ok, ck, nk = (F.col(c) for c in ("l_partkey", "l_orderkey", "o_custkey", "n_nationkey"))
    flag = F.col("l_returnflag")
    qty = F.col("l_quantity").cast("int")
    price = F.col("p_retailprice")

    items = list(FEE_CODES.items())
    stock = F.when(pk % 200 == items[0][0], F.lit(items[0][1]))
    for rem, code in items[1:]:
        stock = stock.when(pk % 200 == rem, F.lit(code))
    stock_code = stock.otherwise(pk.cast("string"))

    is_return = (flag == "R") | (ck % 103 == 7) | ((pk % 10 == 9) & (flag == "A"))
    quantity = (F.when((F.col("l_linenumber") == 7) & (pk % 4 == 0), F.lit(0))
                .when(is_return, -qty).otherwise(qty))
    late = F.col("o_orderdate") >= F.lit(LATE_ORDER_CUTOFF).cast("timestamp_ntz")
    hours = (ok % 12 + F.when(late, F.lit(0)).otherwise(F.lit(11))).cast("int")
    unit_price = (F.when(pk % 97 == 0, F.lit(0.0))
                  .when((pk % 89 == 0) | (ck % 101 == 5), -price)
                  .otherwise(price)).cast("decimal(10,2)").cast(PRICE)
    country = (F.when(nk == DEFAULT_COUNTRY_KEY, F.lit("United Kingdom"))
               .when(nk == BLANK_COUNTRY_KEY, F.lit(""))
               .when(nk == NULL_COUNTRY_KEY, F.lit(None).cast("string"))
               .when(nk == UNSPECIFIED_COUNTRY_KEY, F.lit("Unspecified"))
               .otherwise(F.col("n_name")))

    mapped = lines.select(
        ok.cast("string").alias("InvoiceNo"),
        stock_code.alias("StockCode"),
        F.when(pk % 50 == 3, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("Description"),
        quantity.cast("int").alias("Quantity"),
        F.timestamp_add("HOUR", hours, F.col("o_orderdate")).alias("InvoiceDate"),
        unit_price.alias("UnitPrice"),
        F.when(ck % 10 == 0, F.lit(None).cast("string")).otherwise(ck.cast("string")).alias("CustomerID"),
        country.alias("Country"),
        # one copy per line, two for the duplicated orders: generated in place,
        # so the joins run once
        F.explode(F.sequence(F.lit(1), F.when(ok % DUPLICATE_EVERY == 0, F.lit(2)).otherwise(F.lit(1))))
        .alias("_copy"),
    )
    return mapped.select(*RAW_COLUMNS)
