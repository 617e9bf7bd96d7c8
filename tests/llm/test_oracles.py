"""Registered queries against their DuckDB statements, whole tables."""

import os
import random

import duckdb
import pytest

from tillpoint.llm.decontaminate import contained_items
from tillpoint.llm.oracles import ORACLES
from tillpoint.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r) for r in got.select(*want.columns).collect()]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr)


def test_short_items_by_sql(spark):
    """The statement of operator 1 on texts and items of one to a dozen words."""
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice(["a", "b", "C", "d-e", "f"]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 14))) for i in range(80)] + [(90, None), (None, "a b")]
    items = [(i, text(1 + i % 9)) for i in range(40)] + [(50, None), (51, ""), (None, "a")]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", items)
    got = contained_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = con.sql(ORACLES["op1_decontaminate"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall()) and got.count() > 200


def test_every_numbered_query_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert os.path.exists(os.path.join(os.path.dirname(__spark_entry__.__file__), "corpus_pipeline.py"))
