"""Small helpers: build raw-line frames from hand-written rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tillpoint.schema import RAW_SCHEMA


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def raw_df(spark, rows):
    """rows: (invoice, stock, description, qty, 'YYYY-MM-DD HH:MM', price, customer, country)."""
    fixed = [(r[0], r[1], r[2], r[3], ts(r[4]) if isinstance(r[4], str) else r[4],
              None if r[5] is None else Decimal(str(r[5])), r[6], r[7]) for r in rows]
    return spark.createDataFrame(fixed, RAW_SCHEMA)


def as_dicts(df, order=None):
    rows = df.collect() if order is None else df.orderBy(*order).collect()
    return [r.asDict() for r in rows]
