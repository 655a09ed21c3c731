import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidepanel.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="tidepanel-tests")
    yield s


def rows(df, order=None):
    out = [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
    return out
