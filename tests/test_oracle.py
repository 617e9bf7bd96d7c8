"""Every registered query equals its DuckDB oracle (rows, columns, values).

Runs at sf0.001 by default (fast); set TILLPOINT_ORACLE_SF to another
folder, e.g. /root/testdata/sf0.01 (the driver's gate).
"""

import math
import os

import duckdb
import pytest

from tests.conftest import SF001

from tillpoint.plans.registry import QUERIES

SF = os.environ.get("TILLPOINT_ORACLE_SF", SF001)
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _names():
    import __spark_entry__ as E

    return sorted(set(E.oracle_sql()) & set(QUERIES))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    import datetime as dt
    import decimal

    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)  # exact, as a value hash would be
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != 0 else "0"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _duck_type(t) -> str:
    from pyspark.sql import types as T

    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR",
            T.TimestampNTZType: "TIMESTAMP", T.DateType: "DATE", T.BooleanType: "BOOLEAN"}[type(t)]


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def test_every_query_has_an_oracle():
    import __spark_entry__ as E

    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing, f"queries without oracle: {sorted(missing)}"


@pytest.mark.parametrize("name", _names())
def test_matches_oracle(spark, duck, name):
    import __spark_entry__ as E

    sdf = E.queries()[name](spark, SF)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    dcols, dtypes = rel.columns, [str(t).replace(" ", "") for t in rel.types]
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    # declared column types agree too
    dtype = dict(zip(dcols, dtypes))
    for f in sdf.schema.fields:
        assert _duck_type(f.dataType) == dtype[f.name], (f.name, f.dataType, dtype[f.name])
    assert len(srows) == len(drows)
    idx = sorted(range(len(scols)), key=lambda i: scols[i])
    didx = [dcols.index(scols[i]) for i in idx]
    a = _sorted([tuple(_norm(r[i]) for i in idx) for r in srows])
    b = _sorted([tuple(_norm(r[i]) for i in didx) for r in drows])
    assert a == b


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["month", "monthly_revenue"]
    assert df.count() > 0
