"""Every registered query against its DuckDB oracle at sf0.01 (exact values)."""

import os

import pytest

from landframe.plans import ORACLE, QUERIES, load_all
from tests.conftest import SF001
from tests.oracle_compare import compare_one, duck

load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.skipif(not os.path.isdir(SF001), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare_one(spark, con, name, QUERIES[name], ORACLE.get(name), SF001)
    assert res["status"] in ("exact", "no-oracle"), res
    assert not res.get("type_diffs"), res


def test_every_query_has_an_oracle():
    assert sorted(set(QUERIES) - set(ORACLE)) == []
