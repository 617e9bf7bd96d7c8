"""Table declarations (SK3) and ad-hoc SQL over registered tables (SK6)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import SALES_SCHEMA, SUMMARY_SCHEMA

TABLES: dict[str, T.StructType] = {"sales_data": SALES_SCHEMA, "customer_summary": SUMMARY_SCHEMA}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns (matched case-insensitively) cast to its types.

    Decimal casts round half away from zero; a double goes through its
    shortest decimal text first (what a CSV round trip stores). With ANSI on,
    a number that does not fit the declared precision raises. Text lengths are
    checked when a table is written (``check_lengths``).
    """
    by_lower = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in by_lower]
    if missing:
        raise ValueError(f"columns missing for conform: {missing}")
    return df.select(*[F.col(by_lower[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema.fields])


def check_lengths(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """The same rows; a text with more characters than its column declares
    raises, as an insert into the table would."""
    def checked(name: str, limit: int):
        message = F.concat(F.lit(f"value too long for {name} varchar({limit}): "), F.col(name))
        return F.when(F.char_length(name) > limit, F.raise_error(message)).otherwise(F.col(name))

    return df.withColumns({name: checked(name, limit) for name, limit in lengths.items()})


def register_tables(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Expose DataFrames to SQL under their table names (session-scoped views)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, args: Mapping | None = None,
            tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """SK6: run SQL over the registered tables with bound parameters.

    ``args`` are bound by name (``:country``) and never spliced into the text,
    so user values cannot change the statement.
    """
    if tables:
        register_tables(spark, tables)
    return spark.sql(sql, args=dict(args) if args else None)
