import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripflow.session import checkpoint_root, get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="tripflow-tests")
    checkpoint_root(s)  # unset in tests: a scratch folder is registered
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tripflow.session import work_path
    return work_path(spark, "test")
