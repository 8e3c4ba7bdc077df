"""Every registered query beside its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

# the same fits as in three_model_forecast and shapley_adds_up
COVERED = {"forest_forecast", "sampled_shapley"}


@pytest.mark.parametrize("name", sorted(set(queries()) - COVERED))
def test_query_matches_sql(spark, small, name):
    bad, _ = oracle.differences(spark, small, queries()[name], oracle_sql().get(name))
    assert not bad, bad[:2]


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
