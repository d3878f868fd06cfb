"""Every query of the catalog against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import oracle
import pytest

from catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    columns, got = oracle.of_frame(QUERIES[name](spark, FOLDER))
    want_columns, want = oracle.of_sql(duck, ORACLES[name])
    assert columns == want_columns
    assert got == want
