"""The driver contract: names, stable schemas across scale factors."""

import re

import __spark_entry__ as E
from tillpoint.plans.registry import QUERIES
from tests.conftest import SF001, SF01


def test_names_follow_survey_ids():
    assert set(QUERIES) <= set(E.queries())
    for name in QUERIES:  # the training-data queries are tested in tests/llm
        assert re.fullmatch(r"(sk|p|f|d|a)\d*_[a-z0-9_]+", name), name


def test_schemas_stable_across_scale_factors(spark):
    for name, q in QUERIES.items():
        assert q(spark, SF001).schema == q(spark, SF01).schema, name
