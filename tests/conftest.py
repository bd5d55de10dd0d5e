import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from costledger.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="costledger-tests",
                      extra_conf={"spark.sql.warehouse.dir":
                                  tempfile.mkdtemp(prefix="costledger-warehouse-")})
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A fresh folder per test (never cleared, never shared)."""
    return tempfile.mkdtemp(prefix="costledger-test-")
