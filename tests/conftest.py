import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerolake.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session(app="aerolake-tests", master=os.environ.get("TEST_MASTER", "local[*]"), shuffle_partitions=int(os.environ.get("TEST_PARTITIONS", "8")))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, tmp_path):
    """A fresh scratch directory for file-based tests (local tests only)."""
    return str(tmp_path)
