"""The queries of the general problems on tables without rows and with nothing but NULLs."""

from pathlib import Path

import pytest
from compare import edge_tables

from strandloom.plans import problems

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the tables aren't here")


@pytest.mark.parametrize("kind", ["empty", "nulls"])
def test_nothing_gives_nothing(spark, tmp_path, kind):
    d = edge_tables(SF, tmp_path, kind)
    assert {n: f(spark, d).count() for n, f in problems.QUERIES.items()} == dict.fromkeys(problems.QUERIES, 0)
