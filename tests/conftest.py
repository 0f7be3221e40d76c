import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from revlens import session

    s = session.local_session("*", shuffle_partitions=8, app_name="revlens-tests")
    session.checkpoint_dir(s)  # from spark.checkpoint.dir, or a temporary one in tests
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="revlens-test-")
