"""Every query with SQL gives the SQL's rows, types and names."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare

QUERIES, ORACLES = queries(), oracle_sql()


# Ten folds need more rows than the smallest tables hold; the perceptron takes minutes.
LARGER = {"logistic_rows", "svc_rows", "forest_rows", "mlp_rows"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - LARGER))
def test_matches_sql(spark, small, name):
    result = compare(spark, small, name, QUERIES[name], ORACLES[name])
    assert result["ok"], result


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_rows(spark):
    assert entry(spark).count() == 45


@pytest.mark.parametrize("name", ["item_similarity", "cf_predictions", "language_id", "logistic_rows"])
def test_larger_scale(spark, medium, name):
    result = compare(spark, medium, name, QUERIES[name], ORACLES[name])
    assert result["ok"], result
