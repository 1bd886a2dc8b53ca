"""Every registered query against its reference SQL, or, without one, for a stable non-empty result."""

import pytest
from compare import compare, connect

from yardline.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_reference_sql(spark, duck, name):
    difference = compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    out = QUERIES[name](spark, FOLDER)
    table = out.toArrow()
    assert table.num_rows > 0
    assert table.column_names == out.columns
