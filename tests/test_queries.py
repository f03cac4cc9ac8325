"""Every core query beside its SQL on the smallest tables, where they are."""

from pathlib import Path

import pytest
from compare import differences, duck

from strandloom.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the tables aren't here")
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    said, _, _ = differences(spark, con, SF, registry.queries()[name], SQL.get(name))
    assert said.startswith(("ok", "no SQL")), said


def test_every_query_has_its_sql():
    assert set(registry.queries()) == set(SQL)
