"""The cleaning and summary job.

raw file -> cleaned lines -> product analysis + customer summary -> CSV.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.kpi import pipeline_summary
from ..operators.products import ProductAnalysis, analyze_products
from ..sources.checked import load_transactions
from ..sources.readers import read_transactions
from ..sources.sinks import save_results
from .warehouse import build_warehouse


@dataclass(frozen=True)
class SummaryRun:
    cleaned: DataFrame
    customer_summary: DataFrame
    products: ProductAnalysis
    overview: DataFrame  # one row: lines, revenue, customers, product counts
    csv_paths: dict[str, str]


def read_raw(spark: SparkSession, path: str, fmt: str, timestamp_format: str | None, multi_line: bool, bad_lines: str | None) -> DataFrame:
    if fmt == "csv" and bad_lines:
        return load_transactions(spark, path, timestamp_format=timestamp_format, multi_line=multi_line, bad_lines=bad_lines)
    return read_transactions(spark, path, fmt, timestamp_format=timestamp_format, multi_line=multi_line)


def run_summaries(spark: SparkSession, raw_path: str, output_dir: str, fmt: str = "csv",
                  warehouse_dir: str | None = None, losses: str = "largest", layout: str = "monthly",
                  timestamp_format: str | None = None, multi_line: bool = False, bad_lines: str | None = None) -> SummaryRun:
    """``bad_lines``: a folder for CSV lines that do not fit; all of them are then
    named before the job fails. Without it the first one ends the job."""
    raw = read_raw(spark, raw_path, fmt, timestamp_format, multi_line, bad_lines)
    wh = build_warehouse(spark, raw, warehouse_dir, keep_raw=False, layout=layout)
    clean = wh.clean
    products = analyze_products(clean, losses=losses)
    from pyspark.sql import functions as F

    summary = wh.summary.orderBy(F.col("Total_Net_Revenue").desc(), F.col("CustomerID"))
    paths = save_results(clean, summary, output_dir)
    overview = pipeline_summary(clean, wh.summary, products.counts)
    return SummaryRun(clean, summary, products, overview, paths)
