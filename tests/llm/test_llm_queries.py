"""The queries of the subpackage beside their SQL on the smallest tables, where they are."""

from pathlib import Path

import pytest
from compare import differences, duck

from strandloom.llm import entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the tables aren't here")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    said, _, _ = differences(spark, duck(SF), SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert said.startswith(("ok", "no SQL")), said


def test_entry_adds_them():
    import __spark_entry__ as e

    assert set(entry.queries()) <= set(e.queries()) and set(entry.oracle_sql()) <= set(e.oracle_sql())
