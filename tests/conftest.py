import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    from strandloom.session import importable, local_session

    s = local_session(4, partitions=4, memory="4g")
    importable(s)
    yield s


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
