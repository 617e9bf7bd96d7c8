"""Customer measures: revenue / purchases per customer, the RFM-style summary,
quartile segments and fixed spend segments.

Grouping by customer is one shuffle; the placeholder customer 'Unknown' is a
hot key, absorbed by map-side partial aggregation (distinct invoice counts
are first grouped by (customer, invoice), which spreads it too).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import int_sum, mean, money_sum, ratio, whole_days_between
from ..schema import (
    QUARTILE_LABELS,
    SPEND_SEGMENT_OTHER,
    SPEND_SEGMENTS,
    TOTAL,
    VALUE_NEGATIVE,
    VALUE_POSITIVE,
)
from .filters import Filters, apply_filters, known_customer

MONEY = "decimal(38,2)"


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def _with_domain(agg: DataFrame, domain: DataFrame | None, key: str, zeros: dict[str, Column]) -> DataFrame:
    """Left-join observed aggregates onto the customer domain (both are
    customer-grain and hash-partitioned on the key, so the join adds no
    shuffle of line data). Customers without lines get ``zeros``."""
    if domain is None:
        return agg
    d = domain.select(key).distinct()
    out = d.join(agg, on=key, how="left")
    return out.withColumns({c: F.coalesce(F.col(c), z) for c, z in zeros.items()})


def customer_revenue(clean: DataFrame, domain: DataFrame | None = None, key: str = "CustomerID") -> DataFrame:
    """A2: net revenue per customer, highest first (domain customers without
    lines: 0); equal revenues by customer."""
    agg = clean.groupBy(key).agg(money_sum("Net_Revenue", TOTAL).alias("Net_Revenue"))
    out = _with_domain(agg, domain, key, {"Net_Revenue": F.lit(0).cast(TOTAL)})
    return out.orderBy(F.col("Net_Revenue").desc_nulls_last(), F.col(key))


def purchases_per_customer(clean: DataFrame, domain: DataFrame | None = None, key: str = "CustomerID") -> DataFrame:
    """A5: distinct invoices per customer."""
    agg = clean.groupBy(key).agg(F.count_distinct("InvoiceNo").alias("Purchases"))
    return _with_domain(agg, domain, key, {"Purchases": F.lit(0).cast("bigint")})


def customer_base(clean: DataFrame, domain: DataFrame | None = None, key: str = "CustomerID") -> DataFrame:
    """A6 (+ last purchase for A8): one aggregate per customer."""
    agg = clean.groupBy(key).agg(
        F.count_distinct("InvoiceNo").alias("Total_Purchases"),
        money_sum("Net_Revenue", TOTAL).alias("Total_Net_Revenue"),
        int_sum("Sale_Qty").alias("Total_Sale_Qty"),
        int_sum("Return_Qty").alias("Total_Return_Qty"),
        F.max("InvoiceDate").alias("Last_Purchase"),
    )
    zeros = {"Total_Purchases": F.lit(0).cast("bigint"), "Total_Net_Revenue": F.lit(0).cast(TOTAL),
             "Total_Sale_Qty": F.lit(0).cast("bigint"), "Total_Return_Qty": F.lit(0).cast("bigint")}
    return _with_domain(agg, domain, key, zeros)


def customer_summary(clean: DataFrame, domain: DataFrame | None = None, anchor: Column | None = None,
                     known_only: bool = True, sort: bool = True) -> DataFrame:
    """The customer summary (A6 - A11, F13), highest net revenue first.

    anchor: the reference instant for recency; defaults to the latest line
    over *all* customers (a scalar subquery, evaluated once).
    Customers in ``domain`` without lines get zero totals and NULL
    average / recency / return rate / frequency, value 'Negative'.
    """
    base = customer_base(clean, domain)
    if anchor is None:
        anchor = clean.select(F.max("InvoiceDate")).scalar()
    recency = whole_days_between(F.col("Last_Purchase"), anchor).cast("int")
    out = base.withColumn("RecencyDays", recency).select(
        "CustomerID",
        "Total_Purchases",
        "Total_Net_Revenue",
        "Total_Sale_Qty",
        "Total_Return_Qty",
        ratio("Total_Net_Revenue", "Total_Purchases").alias("Avg_Order_Value"),  # A7
        "RecencyDays",  # A8
        ratio("Total_Return_Qty", "Total_Sale_Qty").alias("Return_Rate"),  # A9
        (F.col("Total_Sale_Qty") - F.col("Total_Return_Qty")).alias("Net_Qty"),  # A9
        (F.col("Total_Purchases").cast("double")
         / ((F.col("RecencyDays").cast("double") + F.lit(1.0)) / F.lit(30.0))).alias("Purchase_Frequency_Monthly"),
        F.when(F.col("Total_Net_Revenue") > 0, F.lit(VALUE_POSITIVE))
        .otherwise(F.lit(VALUE_NEGATIVE)).alias("Customer_Value"),  # A11
    )
    if known_only:
        out = out.filter(known_customer("CustomerID"))
    if sort:
        out = out.orderBy(F.col("Total_Net_Revenue").desc(), F.col("CustomerID"))
    return out


def rfm_base(sales: DataFrame, f: Filters | None = None, by=("country",)) -> DataFrame:
    """Per customer (within ``by``): line count, net revenue, last purchase."""
    df = apply_filters(sales, f)
    return df.groupBy(*_by(by), "customerid").agg(
        F.count(F.lit(1)).alias("frequency"),
        F.coalesce(money_sum("net_revenue", MONEY), F.lit(0).cast(MONEY)).alias("monetary"),
        F.max("invoicedate").alias("last_purchase"),
    )


def _value_counts(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """(keys..., _x, _n): the distinct values of each group and how often each
    occurs. Ties are combined before the shuffle; missing values have no rank."""
    return (df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_x"))
            .agg(F.count(F.lit(1)).alias("_n")))


def _magnitude(v: Column) -> Column:
    """An integer that never falls as ``v`` rises: 256 steps for each doubling,
    so at most some 700,000 different ones, whatever the data."""
    size = F.floor(F.log2(F.abs(v)) * 256) + F.lit(1 << 20)
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0).cast("bigint"))


def _same(left: list[str], right: list[str]) -> list[Column]:
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)]


def _cuts(counts: DataFrame, probs, keys: list[str]) -> DataFrame:
    """Quantiles of ``_value_counts``, one row per group: (keys..., _q)."""
    v = F.col("_x").cast("double")
    placed = counts.select(*keys, v.alias("_v"), "_n", _magnitude(v).alias("_m"))
    by_size = Window.partitionBy(*keys).orderBy("_m")
    steps = placed.groupBy(*keys, "_m").agg(F.sum("_n").alias("_c")).select(
        *keys, "_m", "_c",
        F.coalesce(F.sum("_c").over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_c").over(Window.partitionBy(*keys)).alias("_total"))
    n1 = (F.col("_total") - 1).cast("double")
    ranks = F.array_distinct(F.array(*[side(n1 * p) for p in probs for side in (F.floor, F.ceil)]))
    here = F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c")))
    on = [*keys, "_m"]
    renamed = [f"_t{i}" for i in range(len(on))]
    steps = (steps.select(*[F.col(c).alias(r) for c, r in zip(on, renamed)], "_before", "_total", here.alias("_ranks"))
             .filter(F.size("_ranks") > 0))
    last = F.col("_before") + F.sum("_n").over(Window.partitionBy(*on).orderBy("_v"))
    held = F.filter("_ranks", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_n")))
    # a few rows for each group: its needed ranks and their values
    at = (placed.join(steps, on=_same(on, renamed)).select(*keys, "_v", "_total", "_n", "_ranks", last.alias("_end"))
          .select(*keys, "_v", "_total", F.explode(held).alias("_rank"))
          .groupBy(*keys).agg(F.first("_total").alias("_total"),
                              F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at")))
    cuts = []
    for p in probs:
        lo_v, hi_v = (F.element_at("_at", side(n1 * p)) for side in (F.floor, F.ceil))
        cuts.append(lo_v + (hi_v - lo_v) * (n1 * p - F.floor(n1 * p)))
    return at.select(*keys, F.array(*cuts).alias("_q"))


def exact_quantiles(df: DataFrame, value: str, probs, by=()) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` per ``by`` group, exactly,
    lazily, and without ever holding one group in one task.

    1. Equal values of a group become one row with a count, before the shuffle.
    2. Counts by order of magnitude (``_magnitude``) give the rank at which
       each step of a group begins; their number is bounded by the type.
    3. Only the steps that hold a needed rank (floor / ceil of (n - 1) * p) are
       ordered value by value: distinct values that differ by less than 0.3 %.
       q = lo + (hi - lo) * t.

    Returns (by..., ``_q`` array<double>) with one entry per probability.
    Missing values are left out; a group without any other has no row.
    """
    keys = _by(by)
    return _cuts(_value_counts(df, value, keys), probs, keys)


def quartile_segments(rfm: DataFrame, by=("country",), value: str = "monetary", strict: bool = False) -> DataFrame:
    """Bronze / Silver / Gold / Platinum by quartiles of ``value`` per ``by``.

    Cut points are linear-interpolated quartiles; bins are right-closed and
    the lowest bin includes the minimum. All four labels are always present
    (count 0, mean NULL when empty). Repeated cut points put a value into
    the lowest matching bin; ``strict=True`` raises instead.

    Cut points, counts and means all come from the distinct values and their
    counts. The cut points are group-grain and joined back on the group key
    (AQE broadcasts them when measured small), then one conditional aggregate
    per group is unpivoted to four rows.
    """
    keys = _by(by)
    counts = _value_counts(rfm, value, keys)
    cuts = _cuts(counts, [0.25, 0.5, 0.75], keys)
    if keys:
        renamed = [f"_k{i}" for i in range(len(keys))]
        cuts = cuts.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)], "_q")
        joined = counts.join(cuts, _same(keys, renamed)).drop(*renamed)
    else:
        joined = counts.withColumn("_q", cuts.select("_q").scalar())
    v = F.col("_x").cast("double")
    q1, q2, q3 = (F.col("_q")[i] for i in range(3))
    seg = (F.when(v <= q1, F.lit(0)).when(v <= q2, F.lit(1)).when(v <= q3, F.lit(2)).otherwise(F.lit(3)))
    if strict:
        dup = (q1 == q2) | (q2 == q3)
        seg = F.when(dup, F.raise_error(F.lit("quartile bin edges must be unique"))).otherwise(seg)
    labelled = joined.withColumn("_seg", seg)
    aggs = []
    for i in range(4):
        inside = F.col("_seg") == i
        n = F.coalesce(F.sum(F.when(inside, F.col("_n"))), F.lit(0))
        total = F.sum(F.when(inside, F.col("_x") * F.col("_n")))
        aggs += [n.alias(f"n{i}"), (total.cast("double") / F.nullif(n, F.lit(0)).cast("double")).alias(f"m{i}")]
    per_group = labelled.groupBy(*keys).agg(*aggs)
    rows = [F.struct(F.lit(i).alias("segment_order"), F.lit(lbl).alias("segment"),
                     F.col(f"n{i}").alias("customer_count"), F.col(f"m{i}").alias("avg_monetary"))
            for i, lbl in enumerate(QUARTILE_LABELS)]
    return per_group.select(*keys, F.inline(F.array(*rows)))


def spend_segment(col: str = "total_net_revenue") -> Column:
    c = F.col(col)
    out = None
    for lower, label in SPEND_SEGMENTS:
        out = F.when(c >= lower, F.lit(label)) if out is None else out.when(c >= lower, F.lit(label))
    return out.otherwise(F.lit(SPEND_SEGMENT_OTHER))


def spend_segments(summary: DataFrame, col: str = "total_net_revenue") -> DataFrame:
    """Fixed spend thresholds over customers with positive revenue."""
    return (summary.filter(F.col(col) > 0)
            .groupBy(spend_segment(col).alias("customer_segment"))
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 money_sum(col, MONEY).alias("segment_revenue"),
                 mean(col).alias("avg_revenue_per_customer"))
            .orderBy(F.col("segment_revenue").desc(), F.col("customer_segment")))
