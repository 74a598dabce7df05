import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from factline.session import get_session
    s = get_session("local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)
