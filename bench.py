"""Benchmark: build the tables once, then run every registered operator on them.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). Prints one JSON line.

- ``build_tables``: raw lines (the fixture's joins, landed once as Parquet)
  -> cleaned lines, customer domain, ``sales_data``,
  customer summary (both tiers), each written as Parquet. Timed after one
  untimed warm-up build (JIT compilation of the generated code).
- every registered query: executed fully into Spark's ``noop`` sink (no
  collect to the driver) on the built tables; median of BENCH_REPEAT runs.
- ``dashboard_refresh_one_country``: every dashboard panel for one country
  and the last year (resolving the date range included), median as well.
- ``dashboard_refresh_cached_slice``: the same with the country's lines
  cached once (``plans.dashboard.cached_slice``).
- ``dashboard_refresh_rollup``: the panels of one country and a year of whole days,
  the KPI and time panels from the daily rollup.
- ``end_to_end_*``: headline queries straight from the driver tables
  (fixture joins + cleaning + operator in one plan), median as well.
- ``value`` = sum of all of the above.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    from tillpoint.fixture import raw_transactions
    from tillpoint.plans.inputs import FixtureInputs
    from tillpoint.plans.registry import OPERATORS
    from tillpoint.plans.warehouse import build_warehouse, default_root
    from tillpoint.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="tillpoint-bench",
                          extra={"spark.driver.memory": "16g"})
    root = default_root(spark, f"bench-{os.getpid()}")

    def run(df) -> float:
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def median_of(make) -> float:
        return round(statistics.median(run(make()) for _ in range(repeat)), 3)

    build_warehouse(spark, raw_transactions(spark, sf_dir), f"{root}/warmup", keep_raw=True)
    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    wh = build_warehouse(spark, raw_transactions(spark, sf_dir), f"{root}/tables", keep_raw=True)
    timings["build_tables"] = round(time.perf_counter() - t0, 3)
    from tillpoint.operators.filters import quick_filters
    from tillpoint.plans.dashboard import cached_slice, panels

    def refresh(country_lines=None) -> float:
        # one dashboard interaction: a country, the last year, every panel
        t0 = time.perf_counter()
        f = quick_filters(wh.sales, "year", country="United Kingdom")
        for df in panels(wh.sales, f, compare="yoy", country_lines=country_lines).values():
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    timings["dashboard_refresh_one_country"] = round(statistics.median(refresh() for _ in range(repeat)), 3)
    with cached_slice(wh.sales, "United Kingdom") as part:
        part.count()  # the slice is loaded once per session of interactions, not per refresh
        timings["dashboard_refresh_cached_slice"] = round(
            statistics.median(refresh(part) for _ in range(repeat)), 3)
    from tillpoint.operators.filters import Filters

    def refresh_rollup() -> float:
        t0 = time.perf_counter()
        f = Filters(country="United Kingdom", start="1998-01-01", end="1998-12-31")
        for df in panels(wh.sales, f, compare="yoy", rollup=(wh.hours, wh.customer_days)).values():
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    timings["dashboard_refresh_rollup"] = round(statistics.median(refresh_rollup() for _ in range(repeat)), 3)
    for name in ("a23_monthly_positive", "a12_customer_summary", "a2_customer_revenue", "a17_kpi_block", "a21_monthly_yoy", "a30_quartile_segments"):
        timings[f"end_to_end_{name}"] = median_of(lambda n=name: OPERATORS[n](FixtureInputs(spark, sf_dir)))
    for name, op in OPERATORS.items():
        timings[name] = median_of(lambda o=op: o(wh))
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_seconds_all_queries", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
