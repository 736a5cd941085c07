import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from alnframe.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="alnframe-tests")
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]
