"""Every query with SQL must equal it; the others must run and return rows."""

import pytest

from checks.compare import connect, differences
from checks.oracles import oracle_sql
from checks.queries import QUERIES

SLOW = {"report_json", "algorithm_tournament", "tuned_model", "grid_search", "optimisation_chain", "cv_scores"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in oracle_sql()])
def test_equals_sql(spark, con, sf_dir, name):
    assert differences(spark, con, name, sf_dir) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in oracle_sql() and n not in SLOW])
def test_returns_rows(spark, sf_dir, name):
    assert len(QUERIES[name](spark, sf_dir).take(1)) == 1


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(QUERIES)
