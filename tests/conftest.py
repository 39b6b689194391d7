import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL_SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from newsgraph.session import build_session, drop_scratch

    s = build_session("local[4]", shuffle_partitions=4, app_name="newsgraph-tests",
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield s
    drop_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
