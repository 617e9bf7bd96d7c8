"""What keeps tasks and shuffles small as the tables grow."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.helpers import raw_df
from tests.test_plans import plan
from tillpoint import fixture
from tillpoint.operators import clean as C
from tillpoint.plans.inputs import FixtureInputs
from tillpoint.plans.registry import OPERATORS
from tillpoint.schema import RAW_SCHEMA
from tillpoint.session import path_bytes


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_partitions_of_the_lines_join_follow_the_bytes(spark, monkeypatch):
    plain = fixture.raw_transactions(spark, SF001)
    size = path_bytes(spark, f"{SF001}/lineitem.parquet")
    monkeypatch.setattr(fixture, "JOIN_BYTES", size // 20)
    fine = fixture.raw_transactions(spark, SF001)
    for key in ("l_orderkey", "o_orderkey"):
        assert int(re.search(rf"hashpartitioning\({key}#\d+L, (\d+)\)", plan(fine))[1]) >= 20
    assert _rows(fine) == _rows(plain)


def test_a_part_too_large_to_broadcast_gets_as_many_tasks(spark, monkeypatch):
    plain = fixture.raw_transactions(spark, SF001)
    monkeypatch.setattr(fixture, "JOIN_BYTES", path_bytes(spark, f"{SF001}/lineitem.parquet") // 20)
    monkeypatch.setattr(fixture, "PART_BYTES", 0)
    fine = fixture.raw_transactions(spark, SF001)
    for key in ("l_orderkey", "o_orderkey", "l_partkey", "p_partkey"):
        assert int(re.search(rf"hashpartitioning\({key}#\d+L, (\d+)\)", plan(fine))[1]) >= 20
    assert _rows(fine) == _rows(plain)


def test_written_lines_serve_the_export_and_the_summary(spark):
    src = FixtureInputs(spark, SF001)
    once = src.written
    for name in ("clean", "summary"):
        assert "lineitem" not in plan(getattr(once, name))  # neither joins nor dedup run again
        assert _rows(getattr(once, name)) == _rows(getattr(src, name))


def test_export_joins_the_lines_once(spark, monkeypatch):
    reads = []
    monkeypatch.setattr("tillpoint.plans.inputs.raw_transactions", lambda *a: reads.append(a) or fixture.raw_transactions(*a))
    src = FixtureInputs(spark, SF001)
    assert OPERATORS["sk2_cleaned_csv"](src).count() == src.clean.count()
    assert "written" in vars(src) and "summary" not in vars(src) and len(reads) == 1


def test_a_customer_whose_lines_all_go_is_in_the_written_domain(spark, monkeypatch):
    raw = raw_df(spark, [("1", "A", "d", 1, "2011-01-01 10:00", -1, "c1", "France"), ("2", "A", "d", 1, "2011-01-01 10:00", 1, None, "France"),
                         ("2", "A", "d", 1, "2011-01-01 10:00", 1, None, "France"), ("3", "A", None, 1, None, None, "c2", None)])
    monkeypatch.setattr("tillpoint.plans.inputs.raw_transactions", lambda *_: raw)
    src = FixtureInputs(spark, SF001)
    assert sorted(r[0] for r in src.written.domain.collect()) == sorted(r[0] for r in src.domain.collect()) == ["Unknown", "c1", "c2"]


def test_place_in_the_input_names_files_by_number(spark, scratch):
    spark.range(0, 100, 1, 4).select(F.col("id").alias("n"), (F.col("id") % 10).alias("k")).write.parquet(f"{scratch}/a b%")
    lines = C.with_file_order(spark.read.parquet(f"{scratch}/a b%"))
    assert "string" not in lines.schema[C.FILE_ORDER].dataType.simpleString()  # no path goes through a shuffle
    assert [r["n"] for r in lines.orderBy(C.FILE_ORDER).collect()] == list(range(100))
    assert sorted((r["k"], r["n"]) for r in C.dedup_keys_in_file_order(lines, ["k"]).collect()) == [(k, k) for k in range(10)]


NAMED_ON_SALES = ("a14_date_bounds", "a15_data_period", "a16_countries", "a16_products", "a17_kpi_block", "a17_kpi_block_all_dates",
                  "a17_rollup_kpis", "a20_kpi_cards", "a21_monthly_prev", "a21_monthly_yoy", "a21_rollup_yoy")


@pytest.mark.parametrize("name", NAMED_ON_SALES)
def test_no_derived_column_goes_through_the_key_dedup(spark, name):
    text = plan(OPERATORS[name](FixtureInputs(spark, SF001)))
    firsts = [part.split("))")[0].lower() for part in text.split("min(struct(")[1:]]
    assert firsts and all("quantity" in f and "unitprice" in f for f in firsts)
    assert not any(c in f for f in firsts for c in ("revenue", "sale_qty", "return_qty", "total_items", "is_free_item", "paid_unitprice"))


def test_written_sales_hold_no_derived_column_before_the_dedup(spark, monkeypatch):
    seen = []
    dedup_keys = C.dedup_keys
    monkeypatch.setattr(C, "dedup_keys", lambda df, *a: seen.append(df.columns) or dedup_keys(df, *a))
    assert OPERATORS["a14_footer_bounds"](FixtureInputs(spark, SF001)).count() == 1
    assert seen and set(seen[0]) == {f.name.lower() for f in RAW_SCHEMA.fields}


def test_sales_from_raw_is_the_table_of_the_cleaned_lines(spark):
    day = "2011-01-01 10:00"
    raw = raw_df(spark, [("1", "A", "d", 3, day, 2, "c1", "France"), ("1", "A", "d", 3, day, 2, "c1", "France"), ("1", "A", "d", -3, day, 2, "c1", "France"),
                         ("1", "A", "d", None, day, 2, "c1", "France"), ("1", "B", "d", 3, day, 0, "c1", None), ("1", "B", "d", 3, day, 1, "c1", None),
                         ("1", "B", "d", 3, day, -1, "c1", "A"), ("2", "B", None, 3, None, 5, None, "France"), ("2", "B", "a", 3, day, 5, None, "France"),
                         ("3", None, "d", 4, day, None, "c1", "France"), (None, None, None, 4, day, 1, None, None), (None, None, None, -4, day, 1, None, "")])
    assert _rows(C.sales_from_raw(raw)) == _rows(C.to_sales_table(C.clean_transactions(raw)))
    assert C.sales_from_raw(raw).dtypes == C.to_sales_table(C.clean_transactions(raw)).dtypes


def test_a_task_of_the_lines_join_takes_four_megabytes_of_lines(spark, monkeypatch):
    for size in (64 << 20, 425 << 20, 6 << 30):
        monkeypatch.setattr(fixture, "path_bytes", lambda *_, size=size: size)
        assert size / fixture.join_partitions(spark, SF001) <= 4 << 20


def test_files_of_the_written_table_follow_the_bytes(spark, monkeypatch):
    few = FixtureInputs(spark, SF001).tables.sales
    monkeypatch.setattr(fixture, "JOIN_BYTES", path_bytes(spark, f"{SF001}/lineitem.parquet") // 20)
    many = FixtureInputs(spark, SF001).tables.sales
    assert len(few.inputFiles()) <= 8 < 20 <= len(many.inputFiles())
    assert _rows(many) == _rows(few)
