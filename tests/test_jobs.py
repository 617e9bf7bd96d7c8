"""End-to-end jobs: summaries (E1) -> report (E2), dashboard panels."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF001
from tillpoint.fixture import raw_transactions
from tillpoint.operators.filters import Filters, quick_filters
from tillpoint.plans import dashboard
from tillpoint.plans.inputs import FixtureInputs
from tillpoint.plans.report import run_report
from tillpoint.plans.summaries import run_summaries
from tillpoint.sources.sinks import write_csv
from tillpoint.sources.versions import read_version


def test_summaries_then_report(spark, scratch):
    raw = raw_transactions(spark, SF001)
    raw.write.parquet(f"{scratch}/raw")
    run = run_summaries(spark, f"{scratch}/raw", f"{scratch}/out", fmt="parquet", warehouse_dir=f"{scratch}/wh1")
    src = FixtureInputs(spark, SF001)
    assert run.cleaned.count() == src.clean.count()
    ov = run.overview.first()
    assert ov.total_rows == src.clean.count() and ov.total_customers == src.summary.count()
    assert run.products.top_profitable.count() == 10
    assert set(os.listdir(f"{scratch}/out")) == {"cleaned_retail_data", "customer_summary"}

    res = run_report(spark, run.csv_paths["cleaned"], run.csv_paths["customer_summary"], f"{scratch}/wh2",
                     f"{scratch}/reports", "20260101_000000")
    assert set(res) == {"duplicate_check", "monthly_revenue", "top_countries", "dashboard_metrics"}
    table = read_version(spark, f"{scratch}/wh2/sales_data").drop("invoice_month")  # the layout's own column
    # CSV interchange turns blank countries into NULL; everything else equals the direct load
    want = src.sales.withColumn("country", F.when(F.col("country") != "", F.col("country")))
    assert table.count() == want.count() and table.exceptAll(want).count() == 0
    top = spark.read.option("header", True).csv(res["top_countries"]["latest"])
    assert top.count() == 8


def test_report_from_parquet_keeps_every_text_and_prunes_months(spark, scratch):
    raw_transactions(spark, SF001).write.parquet(f"{scratch}/raw")
    run_summaries(spark, f"{scratch}/raw", f"{scratch}/out", fmt="parquet", warehouse_dir=f"{scratch}/wh1")
    run_report(spark, f"{scratch}/wh1/cleaned_lines", f"{scratch}/wh1/customer_summary_lines", f"{scratch}/wh2",
               f"{scratch}/reports", "r1", fmt="parquet")
    want = FixtureInputs(spark, SF001).sales
    f = Filters(country="United Kingdom", start="1998-01-01", end="1998-12-31")
    for wh in ("wh1", "wh2"):
        table = read_version(spark, f"{scratch}/{wh}/sales_data")
        assert table.count() == want.count()
        assert table.drop("invoice_month").exceptAll(want).count() == 0
        plan = dashboard.panels(table, f)["kpis"]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(invoice_month" in plan


def test_dashboard_panels(spark):
    sales = FixtureInputs(spark, SF001).sales
    doms = dashboard.filter_domains(sales)
    country = doms["countries"].first().country
    for f in (quick_filters(sales, "year", country=country), Filters(country=country),
              Filters(start="1996-01-01", end="1997-12-31"),
              Filters(country=country, products=("blue rod", "hot rod"))):
        panels = dashboard.panels(sales, f, compare="yoy" if f.has_range else "none")
        for name, df in panels.items():
            assert df.count() >= 0, name
    kp = dashboard.panels(sales, Filters(country=country))["kpis"].first()
    assert kp.total_transactions == sales.filter(F.col("country") == country).count()


def test_write_csv_is_partitioned(spark, scratch):
    df = spark.range(1000).repartition(4)
    write_csv(df, f"{scratch}/csv")
    parts = [f for f in os.listdir(f"{scratch}/csv") if f.startswith("part-")]
    assert len(parts) == 4


def test_cli_summaries_and_report(spark, scratch):
    from tillpoint.cli import main

    raw_transactions(spark, SF001).write.parquet(f"{scratch}/raw")
    out = main(["summaries", "--raw", f"{scratch}/raw", "--format", "parquet", "--out", f"{scratch}/out",
                "--warehouse", f"{scratch}/wh1"], spark=spark)
    assert int(out["overview"]["total_rows"]) == FixtureInputs(spark, SF001).clean.count()
    rep = main(["report", "--cleaned", out["csv"]["cleaned"], "--summary", out["csv"]["customer_summary"],
                "--warehouse", f"{scratch}/wh2", "--reports", f"{scratch}/reports", "--run-ts", "r1"], spark=spark)
    assert rep["results"]["dashboard_metrics"]["latest"].endswith("dashboard_metrics/latest")


def test_dashboard_cached_slice_gives_same_panels(spark):
    sales = FixtureInputs(spark, SF001).sales
    f = quick_filters(sales, "year", country="United Kingdom")
    plain = {k: sorted(map(repr, df.collect())) for k, df in dashboard.panels(sales, f, "yoy").items()}
    with dashboard.cached_slice(sales, "United Kingdom") as part:
        cached = {k: sorted(map(repr, df.collect()))
                  for k, df in dashboard.panels(sales, f, "yoy", country_lines=part).items()}
    assert plain == cached
