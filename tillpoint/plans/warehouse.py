"""Materialize the cleaned lines and both tables once, as Parquet.

Each stage is written and read back before the next one uses it: the
written table cuts the lineage (a lost executor recomputes from the last
table, not from the raw file) and the expensive shuffles (whole-line dedup,
key dedup, customer grouping) run exactly once per load.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_transactions, customer_domain, lowercase_columns, sales_from_raw, to_sales_table
from ..functions.columns import month_start
from ..operators.customers import customer_summary
from ..operators.filters import MONTH_PARTITION
from ..schema import SALES_LENGTHS, SUMMARY_LENGTHS, SUMMARY_SCHEMA
from ..session import checkpoint_root
from ..operators.rollup import customer_days, sales_hours
from ..sources.statistics import table_bounds
from ..sources.tables import check_lengths, conform
from ..sources.versions import LOAD, WHOLE, append_load, read_version, replace_version, version
from .inputs import WarehouseInputs


def default_root(spark: SparkSession, name: str = "warehouse") -> str:
    """A folder under the session's shared checkpoint location."""
    return f"{checkpoint_root(spark)}/tillpoint/{name}"


def write_sales(sales: DataFrame, root: str, layout: str, load_id: str | None = None) -> None:
    """Write ``sales_data`` under ``root``, as a whole, or as the load ``load_id``
    beside the table's other loads (the same load again takes its own place).

    layout='sorted': by time within each file (row-group skipping, no extra
    shuffle). layout='monthly': directories per month (``invoice_month``),
    written after a range repartition on (month, time), so a busy month is
    split over many tasks and each task writes to one or two months; date
    filters then prune whole directories.
    """
    if layout == "monthly":
        sales = (sales.withColumn(MONTH_PARTITION, month_start("invoicedate").cast("date"))
                 .repartitionByRange(MONTH_PARTITION, "invoicedate")
                 .sortWithinPartitions("invoicedate"))
    elif layout == "sorted":
        sales = sales.sortWithinPartitions("invoicedate")
    else:
        raise ValueError(f"unknown layout {layout!r}")
    months = [MONTH_PARTITION] if layout == "monthly" else []
    if load_id is None:
        replace_version(sales, f"{root}/sales_data", months)
    else:
        append_load(sales, f"{root}/sales_data", load_id, months)


def write_rollup(spark: SparkSession, root: str, load_id: str | None = None) -> None:
    """The daily rollup of ``sales_data`` under ``root``: of all loads, or of
    ``load_id`` alone, beside the rows of the others."""
    loads = version(spark, f"{root}/sales_data").loads
    if load_id is None and set(loads) - {WHOLE}:
        raise ValueError(f"sales_data has loads of its own; the rollup is kept by load: {sorted(loads)}")
    lines = read_version(spark, f"{root}/sales_data", loads=True)
    if load_id is not None:
        lines = lines.where(F.col(LOAD) == load_id)

    def write(name: str, rows: DataFrame) -> None:
        if load_id is None:
            replace_version(rows, f"{root}/{name}")
        else:
            append_load(rows, f"{root}/{name}", load_id)

    _at_once(lambda: write("sales_hours", sales_hours(lines)), lambda: write("customer_days", customer_days(lines)))


def append_sales(spark: SparkSession, raw: DataFrame, root: str, load_id: str, layout: str = "monthly") -> WarehouseInputs:
    """SK4 as a job: clean a batch of raw lines and add it to ``sales_data`` and to
    the rollup as the load ``load_id``. It may be run again after any failure: the
    load's rows are there once. Keys are unique within a load, as the analysed
    report's are within a file."""
    root = root.rstrip("/")
    write_sales(check_lengths(sales_from_raw(raw), SALES_LENGTHS), root, layout, load_id)
    write_rollup(spark, root, load_id)
    return WarehouseInputs(spark, root, raw=raw)


def _at_once(*jobs: Callable[[], object]) -> None:
    """Run Spark jobs that do not wait for each other side by side: one job's last
    tasks leave no executor idle. The first error is raised when all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def build_warehouse(spark: SparkSession, raw: DataFrame, root: str | None = None,
                    keep_raw: bool = False, layout: str = "sorted") -> WarehouseInputs:
    """Write cleaned lines, customer domain, ``sales_data`` and both summary
    tiers under ``root``.

    The raw input is read where it landed; ``keep_raw=True`` first writes a
    Parquet copy (worth it only when ``raw`` is an expensive derivation, as
    the test fixture's joins are).

    ``layout``: see ``write_sales``; the batch jobs ask for 'monthly'.
    """
    root = (root or default_root(spark)).rstrip("/")
    if keep_raw:
        replace_version(raw, f"{root}/raw_lines")
        raw = WarehouseInputs(spark, root).raw
    wh = WarehouseInputs(spark, root, raw=raw)
    _at_once(lambda: replace_version(clean_transactions(raw), f"{root}/cleaned_lines"),
             lambda: replace_version(customer_domain(raw), f"{root}/customer_domain"))
    clean = wh.clean

    def sales() -> None:
        write_sales(check_lengths(to_sales_table(clean), SALES_LENGTHS), root, layout)
        write_rollup(spark, root)

    def summaries() -> None:
        # the latest line, by which recency counts, stands in the files' footers
        latest = table_bounds(spark, f"{root}/cleaned_lines", "InvoiceDate")[1]
        anchor = F.lit(None if latest is None else latest.isoformat(sep=" ")).cast("timestamp_ntz")
        replace_version(customer_summary(clean, wh.domain, anchor=anchor, sort=False), f"{root}/customer_summary_lines")
        replace_version(check_lengths(conform(lowercase_columns(wh.summary), SUMMARY_SCHEMA), SUMMARY_LENGTHS),
                        f"{root}/customer_summary")

    _at_once(sales, summaries)
    return WarehouseInputs(spark, root, raw=raw)
