"""Input providers: where the raw lines, cleaned lines and tables come from.

``FixtureInputs`` derives everything from the driver's scale-factor folder
(what the registered queries use). ``WarehouseInputs`` reads the tables a
job materialized once (``plans.warehouse.build_warehouse``), which is how the
report and dashboard run on a cluster: the cleaning shuffles happen once,
and each panel scans a Parquet table with pruning and pushdown.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..fixture import FEW, join_partitions, raw_transactions
from ..operators.clean import clean_distinct, clean_transactions, customer_domain, distinct_lines, lowercase_columns, sales_from_raw
from ..operators.customers import customer_summary
from ..operators.rollup import customer_days, sales_hours
from ..schema import SUMMARY_SCHEMA
from ..session import scratch_path
from ..sources.tables import conform
from ..sources.versions import read_version, replace_version


class FixtureInputs:
    """All inputs derived (lazily, once per provider) from one sf folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return raw_transactions(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> DataFrame:
        return clean_transactions(self.raw)

    @cached_property
    def domain(self) -> DataFrame:
        return customer_domain(self.raw)

    @cached_property
    def sales(self) -> DataFrame:
        return sales_from_raw(self.raw)

    @cached_property
    def summary(self) -> DataFrame:
        """Pipeline-tier customer summary (known customers), unsorted."""
        return customer_summary(self.clean, self.domain, sort=False)

    @cached_property
    def summary_table(self) -> DataFrame:
        return conform(lowercase_columns(self.summary), SUMMARY_SCHEMA)

    @cached_property
    def hours(self) -> DataFrame:
        return sales_hours(self.sales)

    @cached_property
    def customer_days(self) -> DataFrame:
        return customer_days(self.sales)

    @cached_property
    def tables(self) -> "WarehouseInputs":
        """``sales_data`` written once, for operators on a table's files. Many lines
        are sorted in tasks of their own, as many as the lines' bytes ask for, and
        not on top of the dedup's sort in as many as the session has."""
        root = scratch_path(self.spark, "tables")
        lines, parts = self.sales, join_partitions(self.spark, self.sf_dir)
        if parts > FEW:
            lines = lines.repartition(parts, "invoiceno")
        replace_version(lines.sortWithinPartitions("invoicedate"), f"{root}/sales_data")
        return WarehouseInputs(self.spark, root)

    @cached_property
    def written(self) -> "DistinctInputs":
        """The distinct lines written once, for queries that take several results
        of them: joins and whole-line dedup run once. A customer's lines lie
        together in each file, which keeps the files and the shuffles by customer small."""
        path = scratch_path(self.spark, "distinct-lines")
        lines = distinct_lines(self.raw)
        lines.sortWithinPartitions("CustomerID", "InvoiceNo").write.option("compression", "zstd").parquet(path)
        return DistinctInputs(self.spark, self.sf_dir, self.spark.read.schema(lines.schema).parquet(path))


class DistinctInputs(FixtureInputs):
    """The inputs that do not need the copies of lines, from written distinct lines
    (a customer has a line among them if there was one at all)."""

    def __init__(self, spark: SparkSession, sf_dir: str, lines: DataFrame):
        super().__init__(spark, sf_dir)
        self.lines = lines

    @cached_property
    def clean(self) -> DataFrame:
        return clean_distinct(self.lines)

    @cached_property
    def domain(self) -> DataFrame:
        return customer_domain(self.lines)


class WarehouseInputs:
    """Inputs read back from a materialized warehouse folder.

    ``raw`` is the landed input when given (it is not copied by default);
    otherwise the folder's ``raw_lines`` copy.
    """

    def __init__(self, spark: SparkSession, root: str, raw: DataFrame | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._raw = raw

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _t(self, name: str) -> DataFrame:
        return read_version(self.spark, self.path(name))

    @cached_property
    def raw(self) -> DataFrame:
        return self._raw if self._raw is not None else self._t("raw_lines")

    @cached_property
    def clean(self) -> DataFrame:
        return self._t("cleaned_lines")

    @cached_property
    def domain(self) -> DataFrame:
        return self._t("customer_domain")

    @cached_property
    def sales(self) -> DataFrame:
        return self._t("sales_data")

    @cached_property
    def summary(self) -> DataFrame:
        return self._t("customer_summary_lines")

    @cached_property
    def summary_table(self) -> DataFrame:
        return self._t("customer_summary")

    @cached_property
    def hours(self) -> DataFrame:
        return self._t("sales_hours")

    @cached_property
    def customer_days(self) -> DataFrame:
        return self._t("customer_days")

    @property
    def tables(self) -> "WarehouseInputs":
        return self

    @property
    def written(self) -> "WarehouseInputs":
        return self
