"""Versioned tables (SK4, SK5), bounds from footers (A14, D7), the daily rollup,
checked loads (SK1), file order (D2), long lists (F4) and ordered exports (SK9)."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.helpers import raw_df
from tillpoint.fixture import raw_transactions
from tillpoint.operators import clean as C
from tillpoint.operators import customers, kpi, rollup, trends
from tillpoint.operators.filters import Filters, product_filter
from tillpoint.plans import dashboard
from tillpoint.plans.inputs import FixtureInputs, WarehouseInputs
from tillpoint.plans.warehouse import append_sales, build_warehouse, write_rollup
from tillpoint.schema import RAW_SCHEMA
from tillpoint.sources import checked, readers, sinks, statistics, versions


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def sales(spark):
    """The table, written once; nothing is left cached for other tests."""
    path = os.path.join(tempfile.mkdtemp(prefix="tillpoint-test-"), "s")
    FixtureInputs(spark, SF001).sales.write.parquet(path)
    return spark.read.parquet(path)


# --- SK5

def _failing(df):
    """The last rows raise when they are written."""
    return df.withColumn("n", F.when(F.col("n") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("long"))


def test_failed_replace_leaves_the_table(spark, scratch):
    path = f"{scratch}/t"
    old = spark.range(5).toDF("n")
    versions.replace_version(old, path)
    with pytest.raises(Exception, match="lost"):
        versions.replace_version(_failing(spark.range(10).toDF("n").repartition(3)), path)
    assert _rows(versions.read_version(spark, path)) == _rows(old)
    versions.replace_version(spark.range(10).toDF("n"), path)
    assert versions.read_version(spark, path).count() == 10
    assert versions.version(spark, path).number == 2


def test_reader_started_before_a_replace_finishes(spark, scratch):
    path = f"{scratch}/t"
    versions.replace_version(spark.range(5).toDF("n"), path)
    reader = versions.read_version(spark, path)
    versions.replace_version(spark.range(50, 53).toDF("n"), path)
    versions.clear_version(spark, path)
    assert reader.count() == 5
    assert versions.read_version(spark, path).count() == 0 and versions.read_version(spark, path).dtypes == reader.dtypes
    assert versions.read_version(spark, path, number=2).count() == 3
    with pytest.raises(ValueError):
        versions.read_version(spark, path, number=9)


def test_table_may_be_replaced_from_itself(spark, scratch):
    path = f"{scratch}/t"
    versions.replace_version(spark.range(10).toDF("n"), path)
    for _ in range(2):
        versions.replace_version(versions.read_version(spark, path).where("n % 2 = 0 or n < 3"), path)
    assert _rows(versions.read_version(spark, path)) == [(0,), (1,), (2,), (4,), (6,), (8,)]


def test_second_writer_commits_on_top_of_the_first(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    versions.append_load(spark.range(3).toDF("n"), path, "a")
    seen = versions._Files.create
    taken = []

    def late(self, file, text):
        if not taken:  # another writer's commit gets in between
            taken.append(file)
            other = json.loads(text)
            other["loads"] = {"a": other["loads"]["a"]}
            assert seen(self, file, json.dumps(other))
        return seen(self, file, text)

    monkeypatch.setattr(versions._Files, "create", late)
    versions.append_load(spark.range(10, 12).toDF("n"), path, "b")
    assert versions.version(spark, path).number == 3
    assert _rows(versions.load_counts(spark, path)) == [("a", 3), ("b", 2)]
    assert not [f for f in os.listdir(f"{path}/_versions") if f.startswith(".") and not f.endswith(".crc")]


def test_old_versions_and_failed_writes_are_removed(spark, scratch):
    path = f"{scratch}/t"
    for k in range(4):
        versions.replace_version(spark.range(k + 1).toDF("n"), path)
    with pytest.raises(Exception, match="lost"):
        versions.replace_version(_failing(spark.range(10).toDF("n")), path)
    assert versions.remove_old(spark, path) == []  # all of today
    gone = versions.remove_old(spark, path, keep=2, grace_seconds=-5)
    assert len(gone) == 3
    assert versions.read_version(spark, path).count() == 4 and versions.read_version(spark, path, number=3).count() == 3
    assert versions.version(spark, path, 1) is None


# --- SK4

def test_repeated_load_has_its_rows_once(spark, scratch):
    path = f"{scratch}/t"
    day = lambda a, z: spark.range(a, z).select(F.col("id").alias("n"), (F.col("id") % 2).alias("part"))
    versions.append_load(day(0, 10), path, "0001", ["part"])
    versions.append_load(day(10, 30), path, "0002")
    versions.append_load(day(10, 30), path, "0002")
    assert _rows(versions.load_counts(spark, path)) == [("0001", 10), ("0002", 20)]  # ids stay text
    versions.append_load(day(10, 13), path, "0002")  # a corrected load: no row of its former attempt is left
    versions.append_load(day(0, 0), path, "0001")
    table = versions.read_version(spark, path)
    assert _rows(table) == [(10, 0), (11, 1), (12, 0)] and table.columns == ["n", "part"]
    assert "PartitionFilters: [isnotnull(part" in table.where("part = 1")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        versions.append_load(spark.range(3), path, "0003")
    with pytest.raises(ValueError):
        versions.append_load(day(0, 1), path, "../x")


def test_failed_load_leaves_the_other_loads(spark, scratch):
    path = f"{scratch}/t"
    versions.append_load(spark.range(3).toDF("n"), path, "a")
    with pytest.raises(Exception, match="lost"):
        versions.append_load(_failing(spark.range(10).toDF("n")), path, "b")
    assert _rows(versions.load_counts(spark, path)) == [("a", 3)]
    versions.append_load(spark.range(10).toDF("n"), path, "b")
    assert _rows(versions.load_counts(spark, path)) == [("a", 3), ("b", 10)]


def test_plain_folder_reads_as_before(spark, scratch):
    spark.range(4).write.parquet(f"{scratch}/plain")
    assert versions.read_version(spark, f"{scratch}/plain").count() == 4 and versions.version(spark, f"{scratch}/plain") is None


# --- A14, A8, F15, D7 from footers

def test_bounds_come_from_footers_alone(spark, scratch, sales):
    path = f"{scratch}/s"
    versions.replace_version(sales, path)
    frame = statistics.footer_bounds(spark, path)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(invoicedate), MAX(invoicedate), COUNT(*)]" in plan
    want = sales.agg(F.min("invoicedate"), F.max("invoicedate"), F.count(F.lit(1))).first()
    assert tuple(frame.first()) == tuple(want)
    assert statistics.table_bounds(spark, path) == tuple(want)[:2]
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert "parquet" in before  # the session's own settings stay
    uk = sales.where("country = 'United Kingdom'").agg(F.min("invoicedate"), F.max("invoicedate")).first()
    assert statistics.table_bounds(spark, path, f=Filters(country="United Kingdom")) == tuple(uk)  # filtered: lines are scanned
    f = dashboard.table_quick_filters(spark, path, "30d")
    assert f.end == want[1] and f.start == want[1] - dt.timedelta(days=30)
    assert dashboard.table_quick_filters(spark, path, "all").start == want[0]


def test_bounds_of_files_without_times_and_of_no_files(spark, scratch):
    path = f"{scratch}/s"
    rows = spark.createDataFrame([(1, dt.datetime(2020, 1, 2, 3)), (2, None)], "n int, invoicedate timestamp_ntz")
    versions.append_load(rows, path, "a", ["n"])
    assert statistics.table_bounds(spark, path) == (dt.datetime(2020, 1, 2, 3),) * 2
    versions.clear_version(spark, path)
    assert statistics.footer_bounds(spark, path) is None and statistics.table_bounds(spark, path) == (None, None)
    assert tuple(statistics.table_date_checks(spark, path, "2020-01-01").first()) == (None, None, 0, 0)


def test_date_checks_read_only_what_the_bounds_ask_for(spark, scratch, sales):
    from tillpoint.operators.quality import date_checks

    path = f"{scratch}/s"
    versions.replace_version(sales, path)
    for now, before in (("2026-01-01", "1990-01-01"), ("1996-05-05", "1995-02-02"), ("2026-01-01", "1995-02-02")):
        got = statistics.table_date_checks(spark, path, now, before)
        assert tuple(got.first()) == tuple(date_checks(sales, now, before, "invoicedate").first())
        scans = got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
        assert scans == (now < "2000") + (before > "1992")


# --- A17-A28 from the rollup

@pytest.mark.parametrize("f", [Filters(), Filters(start="1996-03-01", end="1996-03-01"), Filters(start="1996-02-10", end="1997-01-31"),
                               Filters(country="United Kingdom", start="1995-01-01", end="1998-08-02"), Filters(country="nowhere"),
                               Filters(start=dt.date(1997, 1, 1), end=dt.datetime(1997, 6, 30))])
def test_rollup_panels_equal_the_lines(spark, sales, f):
    hours, days = rollup.sales_hours(sales), rollup.customer_days(sales)
    by = () if f.country else ("country",)
    columns = sorted(kpi.kpi_block(sales, f, by).columns)
    assert _rows(rollup.rollup_kpi_block(hours, days, f, by).select(columns)) == _rows(kpi.kpi_block(sales, f, by).select(columns))
    assert _rows(rollup.rollup_monthly(hours, f, by)) == _rows(trends.monthly_revenue(sales, f, by))
    if f.has_range:
        for mode in ("yoy", "prev"):
            assert _rows(rollup.rollup_comparison(hours, f, mode, by)) == _rows(trends.monthly_comparison(sales, f, mode, by))
    assert _rows(rollup.rollup_monthly_sales(hours, f, by)) == _rows(trends.monthly_sales(sales, f, by))
    assert _rows(rollup.rollup_weekday(hours, f, by)) == _rows(trends.sales_by_weekday(sales, f, by))
    assert _rows(rollup.rollup_hours(hours, f, by)) == _rows(trends.hour_weekday_revenue(sales, f, by))
    assert _rows(rollup.rollup_heatmap(hours, f, by)) == _rows(trends.hour_weekday_heatmap(sales, f, by))
    assert _rows(trends.peak_month(rollup.rollup_monthly_sales(hours, f, by), by=by)) == _rows(trends.peak_month(trends.monthly_sales(sales, f, by), by=by))


def test_rollup_of_awkward_lines(spark):
    line = lambda i, when, q, price, c="c1", country="France": (str(i), "A", "x", q, when, price, c, country)
    rows = [line(1, "2020-01-05 00:00", 1, 2), line(2, "2020-01-05 00:00:01", 1, 3), line(3, "2020-01-04 23:59:59", -2, 5), line(4, "2020-01-05 01:00", 4, 0, None),
            line(5, "2020-01-03 00:00", 2, 1, "c2"), line(6, "2020-01-03 00:30", 2, 1, "c2", None), line(7, "2020-01-05 00:00", 2, 7, "c3"), line(8, None, 1, 1)]
    sales = C.to_sales_table(C.clean_transactions(raw_df(spark, rows)))
    hours, days = rollup.sales_hours(sales), rollup.customer_days(sales)
    for f in (Filters(), Filters(start="2020-01-04", end="2020-01-05"), Filters(start="2020-01-05", end="2020-01-06")):
        columns = sorted(kpi.kpi_block(sales, f).columns)
        assert _rows(rollup.rollup_kpi_block(hours, days, f).select(columns)) == _rows(kpi.kpi_block(sales, f).select(columns))
        assert _rows(rollup.rollup_weekday(hours, f)) == _rows(trends.sales_by_weekday(sales, f))


def test_rollup_refuses_what_it_cannot_answer(spark, sales):
    hours, days = rollup.sales_hours(sales), rollup.customer_days(sales)
    for f in (Filters(start="1996-01-01 10:00:00", end="1997-01-01"), Filters(products=("hot rod",)), Filters(start="soon", end="later")):
        assert not rollup.covers(f)
        with pytest.raises(ValueError):
            rollup.rollup_kpi_block(hours, days, f)


def test_loads_of_sales_keep_the_rollup(spark, scratch):
    raw = raw_transactions(spark, SF001)
    loads = {k: raw.where(F.col("InvoiceNo").cast("bigint") % 3 == k) for k in range(3)}
    for k in (0, 1, 2, 1):  # the second load again
        append_sales(spark, loads[k], f"{scratch}/wh", f"load-{k}")
    wh = WarehouseInputs(spark, f"{scratch}/wh")
    want = FixtureInputs(spark, SF001).sales
    assert _rows(wh.sales.drop("invoice_month")) == _rows(want)  # keys hold the invoice: loads share none
    f = Filters(country="United Kingdom", start="1996-01-01", end="1997-12-31")
    lines = dashboard.panels(wh.sales, f, "yoy")
    fast = dashboard.panels(wh.sales, f, "yoy", rollup=(wh.hours, wh.customer_days))
    for name, df in lines.items():
        assert _rows(fast[name].select(*df.columns)) == _rows(df), name
    assert "sales_data" not in fast["kpis"]._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        write_rollup(spark, f"{scratch}/wh")


def test_cli_append(spark, scratch):
    from tillpoint.cli import main

    sinks.write_csv(raw_transactions(spark, SF001), f"{scratch}/raw")
    args = ["append", "--raw", f"{scratch}/raw", "--warehouse", f"{scratch}/wh", "--load-id", "day1"]
    for _ in range(2):
        assert main(args, spark=spark) == {"load_id": "day1", "rows": FixtureInputs(spark, SF001).sales.count()}


# --- SK1 with every fault named

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"


def _csv(scratch, *lines, header=HEADER):
    os.makedirs(f"{scratch}/in", exist_ok=True)
    with open(f"{scratch}/in/a.csv", "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return f"{scratch}/in"


def test_three_faults_are_three_named_faults(spark, scratch):
    path = _csv(scratch, '1,A,"x, ""y""",2,2011-01-01T10:00:00,1.5,c,France', "2,A,x,two,2011-01-01T10:00:00,1.5,c,France", "3,A,x,2,01/02/2011,1.5,c,France",
                "4,A,x,2,2011-01-01T10:00:00,much,c,France", "5,A,,2,2011-01-01T10:00:00,,,")
    with pytest.raises(checked.BadLines) as e:
        checked.load_transactions(spark, path, bad_lines=f"{scratch}/bad")
    assert e.value.counts == {"Quantity": 1, "InvoiceDate": 1, "UnitPrice": 1} and e.value.lines == 3
    kept = spark.read.parquet(f"{scratch}/bad").collect()
    assert sorted((r["faults"][0], r["_bad_line"][0]) for r in kept) == [("InvoiceDate", "3"), ("Quantity", "2"), ("UnitPrice", "4")]
    assert all(r["_file"].endswith("a.csv") for r in kept)
    good = checked.read_checked(spark, path).where(F.size("faults") == 0).select(*RAW_SCHEMA.names)
    assert [r["Description"] for r in good.orderBy("InvoiceNo").collect()] == ['x, "y"', None]


def test_lines_of_another_length_and_lines_with_two_faults(spark, scratch):
    path = _csv(scratch, "1,A,x,2,2011-01-01T10:00:00,1.5,c,France,more", "2,A,x,2", "3,A,x,q,then,1.5,c,France", '4,A,x,q,"2011-01-01T10:00:00",1.5,c,France,x,y')
    assert {tuple(r) for r in checked.fault_counts(checked.read_checked(spark, path)).collect() if r[1]} == {("(line)", 3), ("Quantity", 1), ("InvoiceDate", 1)}


def test_good_files_load_as_read(spark, scratch):
    sinks.write_csv(raw_transactions(spark, SF001), f"{scratch}/raw")
    assert _rows(checked.load_transactions(spark, f"{scratch}/raw")) == _rows(readers.read_transactions(spark, f"{scratch}/raw"))
    path = _csv(scratch, "1,A,x,2,31.12.2010 08:26,1.5,c,France")
    assert checked.load_transactions(spark, path, timestamp_format="dd.MM.yyyy HH:mm").first()["InvoiceDate"] == dt.datetime(2010, 12, 31, 8, 26)
    with pytest.raises(checked.BadLines):
        checked.load_transactions(spark, path)


def test_line_breaks_are_seen(spark, scratch):
    path = _csv(scratch, '1,A,"two\nlines",2,2011-01-01T10:00:00,1.5,c,France')
    assert readers.has_line_breaks(spark, path)
    assert checked.load_transactions(spark, path, multi_line=True).first()["Description"] == "two\nlines"
    sinks.write_csv(raw_transactions(spark, SF001), f"{scratch}/raw")
    assert not readers.has_line_breaks(spark, f"{scratch}/raw")


# --- D2 in file order

@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_first_line_of_the_file_stays(spark, scratch, fmt):
    rows = [("1", "A", d, 1, f"2011-01-0{k} 10:00", 1, "c", "France") for k, d in enumerate(["zebra", "apple", "mango"], 1)]
    rows += [("2", "B", "only", 1, "2011-01-01 10:00", 1, "c", "France")]
    first, second = raw_df(spark, [rows[0], rows[3]]), raw_df(spark, [rows[1], rows[2]])
    for n, part in (("a", first), ("b", second)):
        writer = part.coalesce(1).write
        (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(f"{scratch}/{n}")
        os.makedirs(f"{scratch}/in", exist_ok=True)
        file = next(f for f in os.listdir(f"{scratch}/{n}") if f.startswith("part-"))
        os.link(f"{scratch}/{n}/{file}", f"{scratch}/in/{n}.{fmt}")
    lines = C.with_file_order(readers.read_transactions(spark, f"{scratch}/in", fmt))
    kept = C.dedup_keys_in_file_order(lines, C.LINE_KEY)
    assert kept.columns == [f.name for f in RAW_SCHEMA.fields]
    assert sorted(r["Description"] for r in kept.collect()) == ["only", "zebra"]  # by values, "apple" would stay
    assert sorted(r["Description"] for r in C.dedup_keys(lines.drop(C.FILE_ORDER), C.LINE_KEY).collect()) == ["apple", "only"]


def test_file_order_holds_over_many_splits(spark, scratch):
    spark.range(0, 50_000, 1, 3).select(F.col("id").alias("n"), (F.col("id") % 1000).alias("k"), F.repeat(F.lit("x"), 50).alias("pad")).write.parquet(f"{scratch}/p")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = C.with_file_order(spark.read.parquet(f"{scratch}/p"))
        kept = C.dedup_keys_in_file_order(lines, ["k"])
        assert sorted((r["k"], r["n"]) for r in kept.collect()) == [(k, k) for k in range(1000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_report_job_keeps_the_first_of_the_file(spark, scratch):
    from tillpoint.plans.report import run_report

    rows = [("1", "A", "zebra", 1, "2011-01-02 10:00", 1, "c", "France"), ("1", "A", "apple", 1, "2011-01-01 10:00", 2, "c", "France")]
    lines = C.clean_transactions(raw_df(spark, rows)).orderBy(F.col("Description").desc())
    sinks.save_results(lines, customers.customer_summary(lines), f"{scratch}/out")
    for first, want in (("file", "zebra"), ("value", "apple")):
        run_report(spark, f"{scratch}/out/cleaned_retail_data", f"{scratch}/out/customer_summary", f"{scratch}/{first}", f"{scratch}/r-{first}", "r1", first=first)
        assert [r["description"] for r in WarehouseInputs(spark, f"{scratch}/{first}").sales.collect()] == [want]


# --- F4

def test_long_list_is_a_join_and_short_one_an_in_list(spark, sales):
    codes = [str(k) for k in range(100_000)] + [None, "AMAZONFEE", "AMAZONFEE"]
    long = product_filter(sales, codes, "stockcode")
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and " IN (" not in plan and "INSET" not in plan and len(plan) < 2_000
    assert long.columns == sales.columns
    assert _rows(long) == _rows(sales.where("stockcode = 'AMAZONFEE' or stockcode rlike '^[0-9]{1,5}$'"))
    names = [r[0] for r in sales.select("description").distinct().limit(20).collect()]
    table = spark.createDataFrame([(n,) for n in names], "name string")
    short = product_filter(sales, names)
    assert "Join" not in short._jdf.queryExecution().optimizedPlan().toString()
    assert _rows(short) == _rows(product_filter(sales, table))


# --- SK9 / L3

def test_export_files_concatenate_in_order(spark, scratch, sales):
    f = Filters(start="1995-01-01", end="1997-12-31")
    path = sinks.export_files(sales, f, scratch, max_lines=100)
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    listed = sorted(map(tuple, sinks.read_manifest(spark, path).collect()))
    header = listed[0][3]
    with open(f"{scratch}/all.csv", "w") as out:
        out.write(header + "\n")
        for name, lines, first, _ in listed:
            text = open(f"{path}/{name}").read()
            assert text.count("\n") == lines <= 100
            out.write(text)
    assert [n for n in names if os.path.getsize(f"{path}/{n}")] == [r[0] for r in listed] and len(listed) > 10
    assert [r[2] for r in listed] == [sum(r[1] for r in listed[:k]) for k in range(len(listed))]
    rows = sinks.export_rows(sales, f)
    got = spark.read.option("header", True).schema(rows.schema).csv(f"{scratch}/all.csv")
    assert got.collect() == rows.withColumn("country", F.when(F.col("country") != "", F.col("country"))).collect()


def test_export_of_no_lines(spark, scratch, sales):
    path = sinks.export_files(sales, Filters(country="nowhere"), scratch)
    assert sinks.read_manifest(spark, path).count() == 0


# --- plans

def test_no_row_is_expanded_for_distinct_counts(spark, scratch):
    wh = build_warehouse(spark, raw_transactions(spark, SF001), f"{scratch}/wh", layout="monthly")
    from tillpoint.plans.registry import OPERATORS

    for name in ("a17_kpi_block", "a17_kpi_block_all_dates", "a20_kpi_cards", "a31_country_revenue", "a38_financial_summary", "p13_formatted_metrics", "a17_rollup_kpis"):
        assert "Expand" not in OPERATORS[name](wh)._jdf.queryExecution().executedPlan().toString(), name


def test_comparison_opens_only_its_months(spark, scratch):
    wh = build_warehouse(spark, raw_transactions(spark, SF001), f"{scratch}/wh", layout="monthly")
    f = Filters(country="United Kingdom", start="1998-01-05", end="1998-03-20")
    for mode, first in (("yoy", "1997-01-01"), ("prev", "1997-10-01")):
        df = trends.monthly_comparison(wh.sales, f, mode)
        plan = df._jdf.queryExecution().sparkPlan().toString()
        at = plan.index("PartitionFilters: [isnotnull(invoice_month")
        assert "invoice_month" in plan[at:at + 400] and first in plan[at:at + 400], plan[at:at + 400]
        assert _rows(df) == _rows(trends.monthly_comparison(FixtureInputs(spark, SF001).sales, f, mode))


def test_customer_revenue_is_in_order(spark):
    src = FixtureInputs(spark, SF001)
    rows = [(-r["Net_Revenue"], r["CustomerID"]) for r in customers.customer_revenue(src.clean, src.domain).collect()]
    assert rows == sorted(rows) and len(rows) > 50
