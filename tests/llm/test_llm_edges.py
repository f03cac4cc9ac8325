"""The queries of the subpackage on tables without rows and with nothing but NULLs."""

from pathlib import Path

import pytest
from compare import edge_tables

from strandloom.llm import entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the tables aren't here")
# One row for each target, each subject, and each document without a leak: here rows of NULLs.
FOLLOW_A_TABLE = {"p7_plan", "p7_shares", "p8_makeup", "p6_clean"}


@pytest.mark.parametrize("kind", ["empty", "nulls"])
def test_nothing_gives_nothing(spark, tmp_path, kind):
    d = edge_tables(SF, tmp_path, kind)
    got = {n: f(spark, d).count() for n, f in entry.queries().items()}
    assert not {n: k for n, k in got.items() if k and (kind == "empty" or n not in FOLLOW_A_TABLE)}
