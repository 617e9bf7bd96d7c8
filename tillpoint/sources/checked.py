"""SK1 + P2 + P3 with every fault named: a load that says which lines and columns
are bad before it raises.

The file is parsed once with the declared types; a line with a value that does not
fit is kept whole by the reader, next to the values that do. Only such lines are
parsed again, as text, to tell which columns are at fault.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_SCHEMA
from .readers import CSV_OPTIONS

BAD = "_bad_line"
FAULTS = "faults"
LINE = "(line)"  # the fault of a line with too few or too many fields


class BadLines(ValueError):
    """Lines that cannot be loaded; ``counts`` has how many by column."""

    def __init__(self, counts: dict[str, int], lines: int, kept_in: str | None):
        self.counts, self.lines, self.kept_in = counts, lines, kept_in
        named = ", ".join(f"{c}: {n}" for c, n in sorted(counts.items()))
        super().__init__(f"{lines} bad lines ({named})" + (f", kept in {kept_in}" if kept_in else ""))


def read_checked(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, timestamp_format: str | None = None,
                 multi_line: bool = False, header: bool = True) -> DataFrame:
    """The columns of ``schema``, then ``faults`` (names of the columns whose text
    does not fit; empty for a good line) and ``_bad_line`` (the line as it stands,
    null for a good one) and ``_file``. Files of CSV are split unless
    ``multi_line``."""
    options = CSV_OPTIONS | {"mode": "PERMISSIVE", "header": str(header).lower(), "columnNameOfCorruptRecord": BAD, "enforceSchema": "true"}
    if timestamp_format:
        options["timestampNTZFormat"] = timestamp_format
    typed = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    lines = spark.read.schema(typed).options(**options).option("multiLine", multi_line).csv(path)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField("_wrong", T.StringType())])
    again = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "mode")} | {"columnNameOfCorruptRecord": "_wrong", "mode": "PERMISSIVE"}
    text = F.from_csv(F.col(BAD), as_text.simpleString(), again)
    at_fault = F.filter(F.array(*[F.when(text[f.name].isNotNull() & F.col(f.name).isNull(), F.lit(f.name)) for f in schema.fields]), lambda c: c.isNotNull())
    faults = F.when(F.col(BAD).isNull(), F.array().cast("array<string>")).when(text["_wrong"].isNotNull() | (F.size(at_fault) == 0), F.array(F.lit(LINE))).otherwise(at_fault)
    return lines.select(*schema.names, faults.alias(FAULTS), BAD, F.col("_metadata.file_path").alias("_file"))


def fault_counts(checked: DataFrame) -> DataFrame:
    """(column_name, bad_values): of every column of a checked load, and of whole
    lines, in one pass."""
    names = [LINE, *[c for c in checked.columns if c not in (FAULTS, BAD, "_file")]]
    one = checked.agg(*[F.count_if(F.array_contains(FAULTS, n)).alias(f"_{i}") for i, n in enumerate(names)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"_{i}").cast("bigint").alias("bad_values")) for i, n in enumerate(names)])))


def load_transactions(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, timestamp_format: str | None = None,
                      multi_line: bool = False, bad_lines: str | None = None) -> DataFrame:
    """SK1: raw lines of a CSV folder whose every line fits the schema. Otherwise
    ``BadLines`` names the columns with their counts; with ``bad_lines`` the bad
    lines are first written there (Parquet: faults, line, file)."""
    checked = read_checked(spark, path, schema, timestamp_format, multi_line)
    wrong = checked.where(F.size(FAULTS) > 0)
    names = [LINE, *schema.names]
    row = checked.agg(F.count_if(F.size(FAULTS) > 0).alias("_lines"), *[F.count_if(F.array_contains(FAULTS, n)).alias(f"_{i}") for i, n in enumerate(names)]).first()
    if row["_lines"]:
        if bad_lines:
            wrong.select(FAULTS, BAD, "_file").write.mode("overwrite").parquet(bad_lines)
        raise BadLines({n: row[f"_{i}"] for i, n in enumerate(names) if row[f"_{i}"]}, row["_lines"], bad_lines)
    return checked.select(*schema.names)
