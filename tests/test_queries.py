"""Every library query against the SQL that gives the same rows, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from kinfold.plans import registry

from .conftest import DATA, same_rows


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_oracle(spark, duck, name):
    same_rows(registry.QUERIES[name](spark, DATA).toPandas(), duck.sql(registry.ORACLE[name]).df())


@pytest.mark.parametrize("name", ["features_all", "model_score", "model_train_large"])
def test_query_without_oracle_has_rows(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"source1_entity_id", "matched_entity_ids", "candidate_entity_ids"} == set(rows[0].asDict())


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_fallback_takes_anchors_from_all_targets(spark):
    found = {r["ord"] % 7 for r in registry.QUERIES["block_fallback"](spark, DATA).select("ord").collect()}
    assert found == set(range(7))
