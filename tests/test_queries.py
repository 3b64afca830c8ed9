"""Queries whose stand-in data must reach what they are about."""

import os

import pytest

from verification.compare import difference, duck
from verification.oracles import ORACLES
from verification.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver's tables are not here")

VALUES = {
    "flashiness_yearly_missing": "flashiness",
    "mam7": "mean_annual_7_day_min",
    "zero_year_probability_mixed": "probability",
    "chunk_roundtrip_small_blocks": "streamflow",
    "broken_chunks": "filled",
    "daily_mean_from_blocks": "streamflow",
    "rechunk_blocks": "streamflow",
    "broken_blocks": "cells",
}


@pytest.mark.parametrize("name", VALUES)
def test_values_differ_between_rows(spark, name):
    values = [r[VALUES[name]] for r in QUERIES[name](spark, SF_DIR).collect()]
    assert len({v for v in values if v is not None}) > 1


def test_queries_with_missing_values_have_some(spark):
    assert any(r["flashiness"] is None for r in QUERIES["flashiness_yearly_missing"](spark, SF_DIR).collect())
    assert any(r["probability"] == 0 for r in QUERIES["zero_year_probability_mixed"](spark, SF_DIR).collect())
    means = QUERIES["daily_mean_from_blocks"](spark, SF_DIR)
    assert 0 < means.where("streamflow is null").count() < means.count()
    summary = QUERIES["grid_summary"](spark, SF_DIR).first()
    assert 0 < summary["streamflow_missing"] < 1 and 0 < summary["velocity_missing"] < 1


def test_heads_are_cut(spark):
    hours = QUERIES["reach_slice_select"](spark, SF_DIR).groupBy("feature_id").count()
    heads = QUERIES["first_rows_per_reach"](spark, SF_DIR).groupBy("feature_id").count()
    assert {r["count"] for r in heads.collect()} == {40} and max(r["count"] for r in hours.collect()) > 40


@pytest.mark.parametrize("name", ["retrospective_overwrite", "chunk_roundtrip_large_blocks", "daily_csv"])
def test_queries_equal_their_sql(spark, name):
    assert difference(spark, SF_DIR, name, duck(SF_DIR)) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
