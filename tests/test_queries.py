"""Every registered query: against its SQL where it has one, otherwise that it runs and returns rows."""

import pytest

import __spark_entry__ as registered
import oracle

SF = "/root/testdata/sf0.001"
ORACLES = registered.oracle_sql()
SLOW_WITHOUT_SQL = {"image_dedup"}  # covered by test_image_dedup


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert oracle.difference(registered.queries()[name](spark, SF), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - set(ORACLES) - SLOW_WITHOUT_SQL))
def test_runs(spark, name):
    assert registered.queries()[name](spark, SF).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(registered.queries())


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns == ["keyword", "image_id", "score", "rank", "band"]
    assert frame.count() > 0
