"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from airgrid.operators.boosting import BoostingSettings
from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - {"grid_search"}))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    assert differences(queries()[name](spark, sf_dir), duck, oracle_sql()[name]) == []


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries()) and list(queries())[-1] == "grid_search"


def test_grid_search_refits_the_best_setting_of_each_segment(spark, sf_dir):
    few = BoostingSettings(iterations=[1, 2], depths=[2, 3], cv_folds=2)
    rows = QUERIES["grid_search"](spark, sf_dir, few).collect()
    assert {(r.iterations, r.depth) for r in rows} == {(1, 2), (2, 2), (1, 3), (2, 3)}
    assert len(rows) == 4 * len({(r.cnlname, r.day_type) for r in rows}) and all(r.r2_possible and r.refitted_if_best for r in rows)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
