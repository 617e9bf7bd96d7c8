"""Sinks (SK4, SK5, SK7, SK8, SK9).

Writes are partition-parallel: no ``coalesce(1)``, no driver-side chunking.
Each write replaces or appends a whole folder through Spark's commit
protocol, so a lost executor's task is retried without partial output.
"""

from __future__ import annotations

import re

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import MONTH_PARTITION, Filters, apply_filters


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """SK4: append rows to a Parquet table folder."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """SK5 + SK4: clear, then append. Not atomic: the old rows go before the new
    ones are written, so ``df`` must not read ``path`` and a failed write leaves
    no table; write it again from its source."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def clear_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """SK5: leave the table empty but keep its schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def save_results(clean: DataFrame, summary: DataFrame, output_dir: str) -> dict[str, str]:
    """SK7: cleaned lines and customer summary as CSV folders (with header)."""
    base = output_dir.rstrip("/")
    paths = {"cleaned": f"{base}/cleaned_retail_data", "customer_summary": f"{base}/customer_summary"}
    write_csv(clean, paths["cleaned"])
    write_csv(summary, paths["customer_summary"])
    return paths


def save_with_latest(df: DataFrame, base_dir: str, name: str, run_timestamp: str) -> dict[str, str] | None:
    """SK8: write a (small) result under ``name/runs/run_ts=...`` (readable as one
    dataset of all runs) and as ``name/latest``; skip when empty.

    The result is persisted so the emptiness check and both writes compute
    it once.
    """
    base = base_dir.rstrip("/")
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if df.isEmpty():
            return None
        paths = {"run": f"{base}/{name}/runs/run_ts={run_timestamp}", "latest": f"{base}/{name}/latest"}
        write_csv(df, paths["run"])
        write_csv(df, paths["latest"])
        return paths
    finally:
        df.unpersist()


def export_rows(sales: DataFrame, f: Filters) -> DataFrame:
    """SK9 rows: the filtered lines, newest first (a range-partitioned sort),
    lines without a date first, lines of one time in the order of their keys.
    A month-partitioned table's layout column is not exported."""
    rows = apply_filters(sales, f).orderBy(
        F.col("invoicedate").desc_nulls_first(), "invoiceno", "stockcode", "customerid")
    return rows.drop(MONTH_PARTITION)


def export_name(f: Filters) -> str:
    def day(v) -> str:
        return str(v)[:10] if v is not None else "all"

    country = re.sub(r"[^A-Za-z0-9_-]+", "_", f.country or "all")
    return f"sales_data_{country}_{day(f.start)}_to_{day(f.end)}"


MANIFEST = "_manifest"  # hidden from Spark's readers


def export_files(sales: DataFrame, f: Filters, output_dir: str, max_lines: int = 1_000_000) -> str:
    """SK9 / L3 as files that concatenate: the sorted lines in CSV files of at most
    ``max_lines`` lines, without header, whose order by name is the export's order.
    ``_manifest`` (JSON) lists them: file, lines, place of the first line, and the
    header that belongs before them all.

    The lines are range-partitioned by the sort, so files follow the ranges; a
    range of many lines is written as several files.
    """
    path = f"{output_dir.rstrip('/')}/{export_name(f)}"
    rows = export_rows(sales, f)
    header = ",".join(rows.columns)
    (rows.write.mode("overwrite").option("maxRecordsPerFile", max_lines).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    lines = read_export(sales.sparkSession, path, rows.schema)
    counts = lines.groupBy("file").agg(F.count(F.lit(1)).alias("lines"))  # a row for each file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    listed = counts.select("file", "lines", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("first_line"), F.lit(header).alias("header"))
    listed.coalesce(1).write.mode("overwrite").json(f"{path}/{MANIFEST}")
    return path


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines of ``export_files`` with their ``file`` (name) and ``line`` (rises
    within the file; a place to order by, not a number of the line)."""
    lines = spark.read.schema(schema).option("quote", '"').option("escape", '"').option("multiLine", True) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return lines.select("*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file string, lines long, first_line long, header string").json(f"{path}/{MANIFEST}")


def export_csv(sales: DataFrame, f: Filters, output_dir: str) -> str:
    """SK9: write the filtered, sorted lines as a CSV folder named after the
    filter (country and dates)."""
    path = f"{output_dir.rstrip('/')}/{export_name(f)}"
    write_csv(export_rows(sales, f), path)
    return path
