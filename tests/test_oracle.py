"""Every registered query against its SQL, on the smallest test tables."""

from pathlib import Path

import pytest

from oracle import compare
from rollkeeper.queries import all_queries, all_sql

FOLDER = Path("/root/testdata/sf0.001")
SQL = all_sql()


@pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, name):
    assert name in SQL
    assert compare(spark, FOLDER, all_queries()[name], SQL[name]) == ""
