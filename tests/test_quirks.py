"""Hand-written rows for each semantic decision of SURVEY §1.4 (Q1-Q24)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_dicts, raw_df, ts
from tillpoint.functions.columns import composite_key, weekday0, weekday_abbr, whole_days_between
from tillpoint.functions.format import format_value
from tillpoint.operators import clean as C
from tillpoint.operators import customers, kpi, products, trends
from tillpoint.operators.filters import Filters, apply_filters, previous_period, quick_filters


def _sales(spark, rows):
    return C.to_sales_table(C.clean_transactions(raw_df(spark, rows)))


def test_q1_dedup_after_fill_nulls_equal(spark):
    rows = [("1", "A", None, 2, "2011-01-01 10:00", 1.5, None, "France"),
            ("1", "A", "Unknown Product", 2, "2011-01-01 10:00", 1.5, "Unknown", "France"),
            ("1", "A", None, 2, "2011-01-01 10:00", 1.5, None, None),
            ("1", "A", None, 2, "2011-01-01 10:00", 1.5, None, None)]
    out = C.clean_transactions(raw_df(spark, rows))
    assert out.count() == 2  # first two collapse after filling; the NULL-country pair collapses


def test_q2_price_filter_drops_missing_and_negative(spark):
    rows = [("1", "A", "x", 1, "2011-01-01 10:00", None, "1", "F"),
            ("2", "A", "x", 1, "2011-01-01 10:00", -1, "1", "F"),
            ("3", "A", "x", 1, "2011-01-01 10:00", 0, "1", "F")]
    out = as_dicts(C.clean_transactions(raw_df(spark, rows)))
    assert [r["InvoiceNo"] for r in out] == ["3"]
    assert out[0]["Is_Free_Item"] == "Yes" and out[0]["Paid_UnitPrice"] == 0


def test_p4_p9_derived_measures(spark):
    rows = [("1", "A", "x", -3, "2011-01-01 10:00", 2.675, "1", "F"),
            ("2", "A", "x", 4, "2011-01-01 10:00", 2.675, "1", "F"),
            ("3", "A", "x", 0, "2011-01-01 10:00", 2.5, "1", "F")]
    out = {r["InvoiceNo"]: r for r in as_dicts(C.clean_transactions(raw_df(spark, rows)))}
    assert (out["1"]["Return_Qty"], out["1"]["Sale_Qty"], out["1"]["Total_Items"]) == (3, 0, 3)
    assert out["1"]["Net_Revenue"] == Decimal("-8.0250") and out["1"]["Revenue"] == 0
    assert out["2"]["Revenue"] == Decimal("10.7000") and out["2"]["Is_Free_Item"] == "No"
    assert (out["3"]["Sale_Qty"], out["3"]["Return_Qty"]) == (0, 0)
    # the table tier rounds the unrounded pipeline values half away from zero
    t = {r["invoiceno"]: r for r in as_dicts(C.to_sales_table(C.clean_transactions(raw_df(spark, rows))))}
    assert t["1"]["net_revenue"] == Decimal("-8.03") and t["1"]["unitprice"] == Decimal("2.68")


def test_q3_ghost_customers(spark):
    rows = [("1", "A", "x", 2, "2011-01-01 10:00", 5, "c1", "F"),
            ("2", "A", "x", 2, "2011-01-02 10:00", -5, "ghost", "F"),
            ("3", "A", "x", 1, "2011-01-03 10:00", 5, None, "F")]
    raw = raw_df(spark, rows)
    cl = C.clean_transactions(raw)
    summ = {r["CustomerID"]: r for r in as_dicts(customers.customer_summary(cl, C.customer_domain(raw)))}
    assert set(summ) == {"c1", "ghost"}  # 'Unknown' removed, ghost kept
    g = summ["ghost"]
    assert (g["Total_Purchases"], g["Total_Net_Revenue"], g["Total_Sale_Qty"]) == (0, 0, 0)
    assert g["Avg_Order_Value"] is None and g["RecencyDays"] is None and g["Return_Rate"] is None
    assert g["Purchase_Frequency_Monthly"] is None and g["Customer_Value"] == "Negative"
    # without a domain only observed customers appear
    assert {r["CustomerID"] for r in customers.customer_summary(cl).collect()} == {"c1"}


def test_q4_recency_whole_24h_periods_anchor_includes_unknown(spark):
    rows = [("1", "A", "x", 1, "2011-01-01 23:00", 1, "c1", "F"),
            ("2", "A", "x", 1, "2011-01-02 22:00", 1, None, "F")]
    s = as_dicts(customers.customer_summary(C.clean_transactions(raw_df(spark, rows))))
    # 23 hours later on the next calendar day: 0 whole days (datediff would say 1)
    assert s[0]["RecencyDays"] == 0
    assert s[0]["Purchase_Frequency_Monthly"] == pytest.approx(30.0)


def test_q5_return_rate_null_when_nothing_sold(spark):
    rows = [("1", "A", "x", -2, "2011-01-01 10:00", 1, "c1", "F"),
            ("2", "A", "x", 4, "2011-01-01 10:00", 1, "c2", "F"),
            ("3", "A", "x", -1, "2011-01-01 11:00", 1, "c2", "F")]
    s = {r["CustomerID"]: r for r in as_dicts(customers.customer_summary(C.clean_transactions(raw_df(spark, rows))))}
    assert s["c1"]["Return_Rate"] is None and s["c1"]["Net_Qty"] == -2
    assert s["c2"]["Return_Rate"] == pytest.approx(0.25)


def test_q6_loss_orders(spark):
    rows = [(str(i), f"P{i}", "x", -i, "2011-01-01 10:00", 1, "c", "F") for i in range(1, 13)]
    rows += [("99", "M", "x", -100, "2011-01-01 10:00", 1, "c", "F")]  # non-product, excluded
    cl = C.clean_transactions(raw_df(spark, rows))
    largest = [r["StockCode"] for r in products.analyze_products(cl, k=3).top_losses.collect()]
    script = [r["StockCode"] for r in products.analyze_products(cl, k=3, losses="script").top_losses.collect()]
    assert largest == ["P12", "P11", "P10"]
    assert script == ["P1", "P2", "P3"]
    assert products.analyze_products(cl).counts.first().asDict() == {"profitable": 0, "loss": 12}


def test_q7_key_dedup_keeps_first_by_remaining_columns(spark):
    rows = [("1", "A", "b-desc", 2, "2011-01-01 10:00", 1, "c", "F"),
            ("1", "A", "a-desc", 5, "2011-01-01 10:00", 1, "c", "F"),
            ("1", "B", "z", 1, "2011-01-01 10:00", 1, "c", None)]
    out = as_dicts(_sales(spark, rows), ["stockcode"])
    assert [(r["stockcode"], r["description"], r["quantity"]) for r in out] == [("A", "a-desc", 5), ("B", "z", 1)]


def test_q8_q9_revenue_and_line_variants(spark):
    rows = [("1", "A", "x", 2, "2011-01-01 10:00", 10, "c", "F"),
            ("2", "B", "x", -1, "2011-01-01 10:00", 10, "c", "F"),
            ("3", "C", "x", 0, "2011-01-01 10:00", 10, "d", "F")]
    s = _sales(spark, rows)
    rep = {r["metric"]: r for r in kpi.report_kpis(s, "r1").collect()}
    assert rep["Total Revenue"]["value"] == 20.0  # positive lines only
    assert rep["Total Transactions"]["value"] == 2.0  # lines with items
    nb = {r["metric"]: r for r in kpi.notebook_kpis(s).collect()}
    assert nb["Total Transactions"]["value"] == 3.0  # every line
    block = kpi.kpi_block(s, Filters(), by=()).first()
    assert block.total_revenue == Decimal("10.00")  # dashboard: all lines


def test_q10_inclusive_between_bare_end_is_midnight(spark):
    rows = [("1", "A", "x", 1, "2011-01-01 00:00", 1, "c", "F"),
            ("2", "A", "x", 1, "2011-01-31 00:00", 1, "c", "F"),
            ("3", "A", "x", 1, "2011-01-31 09:00", 1, "c", "F")]
    s = _sales(spark, rows)
    got = apply_filters(s, Filters(start="2011-01-01", end="2011-01-31")).select("invoiceno").collect()
    assert sorted(r[0] for r in got) == ["1", "2"]
    # one bound alone does not filter
    assert apply_filters(s, Filters(start="2011-01-15")).count() == 3


def test_q11_previous_period(spark):
    days, ps, pe = previous_period("2011-03-11", "2011-03-21")
    r = spark.range(1).select(days.alias("d"), ps.alias("ps"), pe.alias("pe")).first()
    assert (r.d, r.ps, r.pe) == (10, ts("2011-03-01 00:00"), ts("2011-03-10 00:00"))


def test_q12_growth_status(spark):
    rows = [("1", "A", "x", 10, "2011-03-15 10:00", 1, "c", "F"),  # current
            ("2", "A", "x", 5, "2011-03-05 10:00", 1, "c", "F"),  # previous window
            ("3", "A", "x", 7, "2011-03-15 10:00", 1, "d", "G")]  # current only
    s = _sales(spark, rows)
    k = {r["country"]: r for r in as_dicts(kpi.kpi_block(s, Filters(start="2011-03-11", end="2011-03-21")))}
    f = k["F"]
    assert f["prev_revenue"] == Decimal("5.00") and f["growth_pct"] == pytest.approx(100.0)
    assert f["days_with_data"] == 1 and f["expected_days"] == 10
    assert f["data_completeness"] == pytest.approx(10.0) and f["growth_status"] == "partial"
    assert k["G"]["growth_status"] == "na" and k["G"]["growth_pct"] is None
    cards = {r["country"]: r for r in as_dicts(kpi.kpi_cards(kpi.kpi_block(s, Filters(start="2011-03-11",
                                                                                     end="2011-03-21"))))}
    assert cards["F"]["growth_card"] == "+100.0%*" and cards["G"]["growth_card"] == "N/A"


def test_q13_heatmap_keyed_by_true_day(spark):
    rows = [("1", "A", "x", 1, "2011-01-02 09:00", 3, "c", "F"),  # Sunday
            ("2", "A", "x", 1, "2011-01-05 09:00", 4, "c", "F")]  # Wednesday
    h = kpi_first = trends.hour_weekday_heatmap(_sales(spark, rows), by=()).first()
    assert (h.hour, h.sun, h.mon, h.wed, h.sat) == (9, Decimal("3.00"), 0, Decimal("4.00"), 0)
    assert kpi_first is h


def test_q14_quartiles_and_repeated_edges(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8]
    rfm = spark.createDataFrame([("c%d" % v, Decimal(v)) for v in vals], "customerid string, monetary decimal(38,2)")
    seg = {r["segment"]: r for r in customers.quartile_segments(rfm, by=()).collect()}
    # cut points 2.75 / 4.5 / 6.25 (linear interpolation)
    assert [seg[k]["customer_count"] for k in ("Bronze", "Silver", "Gold", "Platinum")] == [2, 2, 2, 2]
    assert seg["Bronze"]["avg_monetary"] == pytest.approx(1.5)
    tied = spark.createDataFrame([("c%d" % i, Decimal(5)) for i in range(6)] + [("x", Decimal(9))],
                                 "customerid string, monetary decimal(38,2)")
    seg = {r["segment"]: r for r in customers.quartile_segments(tied, by=()).collect()}
    assert seg["Bronze"]["customer_count"] == 6 and seg["Silver"]["customer_count"] == 0
    assert seg["Silver"]["avg_monetary"] is None and seg["Platinum"]["customer_count"] == 1
    with pytest.raises(Exception):
        customers.quartile_segments(tied, by=(), strict=True).collect()


def test_q17_bround_half_even(spark):
    rows = [("1", "A", "x", 2, "2011-01-01 10:00", 1, "c", "F"),
            ("2", "B", "x", 3, "2011-01-01 10:00", 1, "c", "F")]
    b = kpi.kpi_block(_sales(spark, rows), Filters(), by=()).first()
    assert b.avg_items_exact == 2.5 and b.avg_items == 2.0


def test_q19_composite_key_null(spark):
    df = spark.createDataFrame([("1", "A", None), ("1", "A", "c")], "a string, b string, c string")
    keys = [r[0] for r in df.select(composite_key("a", "b", "c")).collect()]
    assert sorted(keys, key=str) == ["1-A-c", None] or keys.count(None) == 1


def test_q22_weekday_zero_is_sunday(spark):
    df = spark.createDataFrame([(ts("2011-01-02 10:00"),), (ts("2011-01-08 10:00"),)], "t timestamp_ntz")
    got = [(r[0], r[1]) for r in df.select(weekday0("t"), weekday_abbr("t")).collect()]
    assert got == [(0, "Sun"), (6, "Sat")]


def test_q24_empty_inputs(spark):
    s = _sales(spark, [("1", "A", "x", 1, "2011-01-01 10:00", -1, "c", "F")])
    assert s.count() == 0
    rep = {r["metric"]: r for r in kpi.report_kpis(s, "r").collect()}
    assert rep["Total Revenue"]["display"] == "0" and rep["Total Customers"]["value"] == 0.0
    nb = {r["metric"]: r for r in kpi.notebook_kpis(s).collect()}
    assert nb["Total Revenue"]["display"] == "$0.00"
    assert trends.monthly_revenue(s).count() == 0


def test_recency_helper_vs_calendar_days(spark):
    r = spark.range(1).select(whole_days_between(F.lit("2011-01-01 23:00").cast("timestamp_ntz"),
                                                 F.lit("2011-01-03 01:00").cast("timestamp_ntz"))).first()[0]
    assert r == 1


def test_format_value_styles(spark):
    df = spark.createDataFrame([(1234567.891, "currency"), (1234.0, "count"), (12.25, "percent"),
                                (2404.0, "days"), (None, "currency"), (2.25, "decimal")],
                               "v double, f string")
    rep = [r[0] for r in df.select(format_value("v", F.col("f"), "report")).collect()]
    assert rep == ["$1,234,567.89", "1,234", "12.2%", "2404 days", "0", "2.25"]
    nb = [r[0] for r in df.select(format_value("v", F.col("f"), "notebook")).collect()]
    assert nb[4] == "$0.00" and nb[5] == "2.2"


def test_quick_ranges_anchor_at_latest_line(spark):
    rows = [("1", "A", "x", 1, "2011-01-01 10:00", 1, "c", "F"),
            ("2", "A", "x", 1, "2011-12-09 12:50", 1, "c", "F")]
    s = _sales(spark, rows)
    f = quick_filters(s, "30d")
    assert (f.start, f.end) == (ts("2011-11-09 12:50"), ts("2011-12-09 12:50"))
    assert apply_filters(s, f).count() == 1
    lazy = quick_filters(s, "30d", resolve=False)  # scalar subqueries, same bounds
    r = spark.range(1).select(lazy.start.alias("s"), lazy.end.alias("e")).first()
    assert (r.s, r.e) == (f.start, f.end)
    assert apply_filters(s, lazy).count() == 1


def test_duplicate_rows_chunked_large_group(spark):
    from tillpoint.operators import quality

    rows = [("1", "A", "x", 1, "2011-01-01 10:00", 1, "c", "F")] * 25 + \
           [("2", "A", "x", 1, "2011-01-01 10:00", 1, "c", "F")] * 3 + \
           [("3", "A", "x", 1, "2011-01-01 10:00", 1, "c", "F")]
    df = raw_df(spark, rows)
    got = quality.duplicate_rows(df, chunk=4).groupBy("InvoiceNo").count().collect()
    assert sorted((r[0], r[1]) for r in got) == [("1", 24), ("2", 2)]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50])
def test_exact_quantiles_match_numpy_and_split_hot_group(spark, n):
    import numpy as np

    rng = np.random.default_rng(n)
    hot = [float(x) for x in rng.integers(-500, 5000, size=n * 40) / 4]  # ties included
    small = [float(x) for x in rng.integers(0, 100, size=n)]
    rows = [("hot", v) for v in hot] + [("small", v) for v in small] + [(None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r._q for r in customers.exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["g"]).collect()}
    for key, vals in (("hot", hot), ("small", small), (None, [1.0, 3.0])):
        want = np.quantile(np.array(vals), [0.25, 0.5, 0.75])
        assert got[key] == pytest.approx(list(want), rel=1e-12, abs=1e-9)
    whole = customers.exact_quantiles(df, "v", [0.5], []).first()._q[0]
    assert whole == pytest.approx(float(np.quantile(np.array(hot + small + [1.0, 3.0]), 0.5)))


def test_quartiles_collapse_ties_and_start_no_job(spark):
    import numpy as np

    vals = [0] * 9000 + [int(x) for x in np.random.default_rng(3).integers(-10**6, 10**6, size=1000)]
    rfm = spark.createDataFrame([("hot", Decimal(v) / 100) for v in vals] + [("none", None), (None, Decimal(7))],
                                "country string, monetary decimal(38,2)").repartition(8)
    counts = customers._value_counts(rfm, "monetary", ["country"])
    assert counts.filter("country = 'hot'").count() <= 1001  # nine tenths of the rows are one row with a count
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quartiles", "plan only")
    seg = customers.quartile_segments(rfm)
    assert not tracker.getJobIdsForGroup("quartiles")
    spark.sparkContext.setJobGroup("", "")
    assert "rangepartitioning" not in seg._jdf.queryExecution().executedPlan().toString()
    got = {(r.country, r.segment): r.customer_count for r in seg.collect()}
    v = np.array(vals) / 100
    edges = [-np.inf, *np.quantile(v, [0.25, 0.5, 0.75]), np.inf]
    for lo, hi, name in zip(edges, edges[1:], ("Bronze", "Silver", "Gold", "Platinum")):
        assert got["hot", name] == ((v > lo) & (v <= hi)).sum()
    assert got[None, "Bronze"] == 1 and not any(k == "none" for k, _ in got)


def test_shuffle_partition_sizing():
    from tillpoint.session import shuffle_partitions_for

    assert shuffle_partitions_for(10 << 20) == 8
    assert shuffle_partitions_for(100 * 10**12) == 372530


def test_checkpoint_dir_comes_from_the_session(spark):
    from tillpoint.session import checkpoint_root, ensure_checkpoint_dir

    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and ensure_checkpoint_dir(spark) == configured
    assert checkpoint_root(spark) == configured.rstrip("/")


def test_growth_text_matches_python_signed_format(spark):
    from tillpoint.functions.format import format_pattern

    vals = [-0.04, 0.0, 0.04, 12.25, -12.25, 1234.56]
    g = F.col("g")
    df = spark.createDataFrame([(v,) for v in vals], "g double")
    got = [r[0] for r in df.select(F.concat(F.when(g >= 0, F.lit("+")).otherwise(F.lit("")),
                                            format_pattern(g, "0.0"), F.lit("%"))).collect()]
    assert got == [f"{v:+.1f}%" for v in vals]
