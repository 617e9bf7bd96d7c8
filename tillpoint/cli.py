"""Command-line entry points, for ``spark-submit`` or ``python -m tillpoint``.

    python -m tillpoint summaries --raw DIR [--format csv|parquet] --out DIR --warehouse DIR
    python -m tillpoint append --raw DIR [--format csv|parquet] --warehouse DIR --load-id ID
    python -m tillpoint report --cleaned DIR --summary DIR [--format csv|parquet] --warehouse DIR --reports DIR [--run-ts TS]

All write ``sales_data`` in month directories unless ``--layout sorted`` is given.
Raw CSV: ``--timestamp-format`` names its time pattern (ISO text otherwise),
``--multi-line`` allows line breaks in fields, ``--bad-lines DIR`` keeps and counts
every line that does not fit before the job fails.

The master comes from ``spark-submit`` (or ``--master`` for a local run).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import functions as F


def main(argv: list[str] | None = None, spark=None) -> dict:
    ap = argparse.ArgumentParser(prog="tillpoint")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=None, help="default: the session's own setting")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("summaries", help="raw lines -> cleaned lines, customer summary, product analysis")
    s.add_argument("--raw", required=True)
    s.add_argument("--format", default="csv", choices=["csv", "parquet"])
    s.add_argument("--out", required=True)
    s.add_argument("--warehouse", required=True)
    p = sub.add_parser("append", help="raw lines -> one more load of sales_data and the rollup; may be repeated")
    p.add_argument("--raw", required=True)
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--warehouse", required=True)
    p.add_argument("--load-id", required=True)
    for job in (s, p):
        job.add_argument("--timestamp-format", default=None)
        job.add_argument("--multi-line", action="store_true")
        job.add_argument("--bad-lines", default=None)
    r = sub.add_parser("report", help="cleaned lines + summary -> tables and report results")
    r.add_argument("--cleaned", required=True)
    r.add_argument("--summary", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--reports", required=True)
    r.add_argument("--run-ts", default=None)
    r.add_argument("--format", default="csv", choices=["csv", "parquet"])
    r.add_argument("--first", default="value", choices=["value", "file"], help="which of a key's lines stays")
    r.add_argument("--multi-line", default="auto", choices=["auto", "yes", "no"], help="line breaks in fields of the CSV")
    for job in (s, p, r):
        job.add_argument("--layout", default="monthly", choices=["monthly", "sorted"])
    a = ap.parse_args(argv)

    if spark is None:
        from .session import build_session

        spark = build_session(a.master, a.shuffle_partitions)
    if a.cmd == "summaries":
        from .plans.summaries import run_summaries

        run = run_summaries(spark, a.raw, a.out, fmt=a.format, warehouse_dir=a.warehouse, layout=a.layout,
                            timestamp_format=a.timestamp_format, multi_line=a.multi_line, bad_lines=a.bad_lines)
        overview = run.overview.first().asDict()  # one row
        out = {"csv": run.csv_paths, "overview": {k: str(v) for k, v in overview.items()}}
    elif a.cmd == "append":
        from .plans.summaries import read_raw
        from .plans.warehouse import append_sales
        from .sources.versions import load_counts

        raw = read_raw(spark, a.raw, a.format, a.timestamp_format, a.multi_line, a.bad_lines)
        wh = append_sales(spark, raw, a.warehouse, a.load_id, a.layout)
        counts = load_counts(spark, wh.path("sales_data")).where(F.col("load_id") == a.load_id).first()
        out = {"load_id": a.load_id, "rows": 0 if counts is None else counts["rows"]}
    else:
        from .plans.report import run_report

        ts = a.run_ts or dt.datetime.now().strftime("%Y%m%d_%H%M%S")
        out = {"run_timestamp": ts, "results": run_report(spark, a.cleaned, a.summary, a.warehouse, a.reports, ts,
                                                             fmt=a.format, layout=a.layout, first=a.first,
                                                             multi_line={"auto": None, "yes": True, "no": False}[a.multi_line])}
    print(json.dumps(out, default=str))
    return out
