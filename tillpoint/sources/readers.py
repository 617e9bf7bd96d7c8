"""Readers (SK1, SK2): explicit schemas, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import lowercase_columns
from ..schema import CLEAN_SCHEMA, PIPELINE_SUMMARY_SCHEMA, RAW_SCHEMA
from .versions import read_version


# standard CSV: a quote within a quoted field is doubled; blanks are kept
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_transactions(spark: SparkSession, path: str, fmt: str = "csv", schema=RAW_SCHEMA,
                      timestamp_format: str | None = None, multi_line: bool = False) -> DataFrame:
    """SK1: raw invoice lines from a CSV (with header) or Parquet folder.

    CSV is read with the declared schema (splittable, no inference pass);
    an empty field reads as NULL, as in any CSV interchange. ``multi_line``
    accepts line breaks within quoted fields, at the cost of splitting files.
    Parquet columns are cast to the schema so later stages see the same types.
    """
    if fmt == "csv":
        r = spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", multi_line)
        if timestamp_format:
            r = r.option("timestampNTZFormat", timestamp_format)
        return r.csv(path)
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    raise ValueError(f"unsupported format {fmt!r}")


def load_csv_data(spark: SparkSession, cleaned_path: str, customer_path: str,
                  multi_line: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """SK2: the pipeline's cleaned lines and customer summary, column names in
    lower case, timestamps parsed (ISO text). Descriptions may hold line breaks,
    and then a file is read in one piece; ``multi_line=None`` looks whether a
    field of the cleaned lines does, in one scan of their text, and otherwise
    reads the files in splits."""
    if multi_line is None:
        multi_line = has_line_breaks(spark, cleaned_path)
    r = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)
    lines, summary = r.schema(CLEAN_SCHEMA).csv(cleaned_path), r.schema(PIPELINE_SUMMARY_SCHEMA).csv(customer_path)
    return lowercase_columns(lines), lowercase_columns(summary)


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field of a CSV folder goes over a line's end: some line
    then has an odd number of quotes (a quote within a field is doubled)."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def load_tables(spark: SparkSession, cleaned_path: str, customer_path: str, fmt: str = "csv",
                multi_line: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """SK2 from either form in which the summaries job leaves its results: the
    CSV export, or its warehouse's ``cleaned_lines`` and ``customer_summary_lines``
    (Parquet: splittable, typed, every text as it was)."""
    if fmt == "csv":
        return load_csv_data(spark, cleaned_path, customer_path, multi_line)
    if fmt == "parquet":
        return lowercase_columns(read_version(spark, cleaned_path)), lowercase_columns(read_version(spark, customer_path))
    raise ValueError(f"unsupported format {fmt!r}")
