"""Every query against its SQL twin on the smallest tables."""

import os

import pytest

from catalog import ORACLES, QUERIES
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_searches_are_repeatable(spark):
    first, second = (QUERIES["cv_random"](spark, FOLDER).collect() for _ in range(2))
    assert [r["params"] for r in first] == [r["params"] for r in second]
    assert [r["avg_metric"] for r in first] == pytest.approx([r["avg_metric"] for r in second])


def test_entry(spark):
    from __spark_entry__ import entry
    assert entry(spark).count() > 0
