"""Every registered query against its oracle on the smallest tables."""

import os
from pathlib import Path

import pytest
from oracle import connect, differences

from periodica.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("CATALOG_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.queries().keys() == QUERIES.keys() | entry.CORPUS_QUERIES.keys()
    result = entry.entry(spark)
    assert result.columns == ["manufacturer", "region", "frequency", "date", "measure", "value"]
