import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from salesmart.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder below the session's checkpoint folder."""
    from salesmart.session import scratch_path
    return scratch_path(spark, "tests", fresh=True)
