import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from scorewright.session import get_spark
    s = get_spark("local[4]", 8, app_name="scorewright-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, order=None):
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda d: tuple(d[k] for k in order))
    return out
