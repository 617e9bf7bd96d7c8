"""The batch report.

cleaned lines + summary (CSV or Parquet) -> key dedup -> replace both tables -> checks,
monthly revenue, top countries, KPI list -> result folders (per run and
'latest').
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import kpi, quality, rankings, trends
from ..operators.clean import SALES_KEY, dedup_keys, dedup_keys_in_file_order, with_file_order
from ..schema import SALES_LENGTHS, SALES_SCHEMA, SUMMARY_LENGTHS, SUMMARY_SCHEMA
from ..sources.readers import load_tables
from ..sources.sinks import save_with_latest
from ..sources.tables import check_lengths, conform
from ..sources.versions import replace_version
from .inputs import WarehouseInputs
from .warehouse import write_rollup, write_sales


def run_report(spark: SparkSession, cleaned: str, summary_path: str, warehouse_dir: str, report_dir: str,
               run_timestamp: str, fmt: str = "csv", layout: str = "monthly", first: str = "value",
               multi_line: bool | None = None) -> dict[str, dict | None]:
    """``first``: of lines of one key the first by their other columns stays
    ('value'), or the first in the input files ('file', as the analysed report does)."""
    lines, summary = load_tables(spark, cleaned, summary_path, fmt, multi_line)
    if first == "file":
        lines = dedup_keys_in_file_order(with_file_order(lines))
    elif first == "value":
        lines = dedup_keys(lines, SALES_KEY, ["description", "quantity", "invoicedate", "unitprice", "country"])
    else:
        raise ValueError(f"unknown order {first!r}")
    sales = check_lengths(conform(lines, SALES_SCHEMA), SALES_LENGTHS)
    root = warehouse_dir.rstrip("/")
    write_sales(sales, root, layout)
    write_rollup(spark, root)
    replace_version(check_lengths(conform(summary, SUMMARY_SCHEMA), SUMMARY_LENGTHS), f"{root}/customer_summary")
    wh = WarehouseInputs(spark, root)
    tables = wh.sales
    results = {
        "duplicate_check": quality.key_check(tables),
        "monthly_revenue": trends.monthly_positive_revenue(tables).orderBy("month"),
        "top_countries": rankings.top_countries(tables, k=8, positive_only=True),
        "dashboard_metrics": kpi.report_kpis(tables, run_timestamp),
    }
    return {name: save_with_latest(df, report_dir, name, run_timestamp) for name, df in results.items()}
