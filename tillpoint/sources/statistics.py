"""Bounds of a table's timestamps from its Parquet footers.

Spark's file source of the second kind pushes MIN, MAX and COUNT into the scan,
which then reads footers only. It does so for integers, not for timestamps: the
column is read as the microseconds that its files hold. The scan takes columns by
their place in the files, so the files' whole schema is given. A session of its own
carries the two settings this needs; the caller's stays as it is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import Filters, apply_filters, ts_bound
from ..schema import SUSPICIOUS_BEFORE
from .versions import LOAD, read_version, version

EPOCH = dt.datetime(1970, 1, 1)


def footer_session(spark: SparkSession) -> SparkSession:
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


def footer_bounds(spark: SparkSession, path: str, column: str = "invoicedate") -> DataFrame | None:
    """(min_date, max_date, lines) of a versioned table, its footers alone being
    read; None if the table has no versions or no loads, or the column is not a
    zone-less timestamp of its files."""
    path = path.rstrip("/")
    table = version(spark, path)
    if table is None or not table.loads or column in table.partition_by:
        return None
    fields = [f for f in table.schema.fields if f.name not in table.partition_by]
    if dict((f.name, f.dataType) for f in fields).get(column) != T.TimestampNTZType():
        return None
    as_long = [T.StructField(f.name, T.LongType() if f.dataType == T.TimestampNTZType() else f.dataType) for f in fields]
    inside = [f for f in table.schema.fields if f.name in table.partition_by]
    schema = T.StructType([*as_long, T.StructField(LOAD, T.StringType()), T.StructField("attempt", T.StringType()), *inside])
    files = footer_session(spark).read.schema(schema).option("basePath", path).parquet(*table.folders(path))
    found = files.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("lines"))
    tick = F.expr("INTERVAL '0.000001' SECOND")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return found.select((epoch + F.col("lo") * tick).alias("min_date"), (epoch + F.col("hi") * tick).alias("max_date"), "lines")


def table_bounds(spark: SparkSession, path: str, column: str = "invoicedate", f: Filters | None = None) -> tuple[dt.datetime | None, dt.datetime | None]:
    """First and last time in a table. With a filter, or where a file has
    no statistics, its lines are scanned."""
    if f is None or (f.country is None and f.products is None and not f.has_range):
        footers = footer_bounds(spark, path, column)
        if footers is not None:
            try:
                row = footers.first()
                return row["min_date"], row["max_date"]
            except Exception as e:  # a file whose lines have no time at all has no bounds in its footer
                if "min/max" not in str(e):
                    raise
    row = apply_filters(read_version(spark, path), f, ts=column).agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return row["lo"], row["hi"]


def table_date_checks(spark: SparkSession, path: str, now, before=SUSPICIOUS_BEFORE, column: str = "invoicedate") -> DataFrame:
    """D7 of a table: earliest and latest line, lines after ``now`` and before
    ``before``. A side that the bounds show to be empty is not read; of the other
    the filter reaches the scan, which skips row groups by their statistics."""
    lo, hi = table_bounds(spark, path, column)
    limits = spark.range(1).select(ts_bound(now).alias("now"), ts_bound(before).alias("before")).first()

    def bound(v):
        return F.lit(None).cast("timestamp_ntz") if v is None else ts_bound(v)

    def outside(there: bool, where):
        if not there:
            return F.lit(0).cast("long")
        return read_version(spark, path).where(where).select(F.count(F.lit(1))).scalar()

    c = F.col(column)
    return spark.range(1).select(
        bound(lo).alias("earliest"), bound(hi).alias("latest"),
        outside(hi is not None and hi > limits["now"], c > ts_bound(now)).alias("future_dates"),
        outside(lo is not None and lo < limits["before"], c < ts_bound(before)).alias("suspicious_dates"))
