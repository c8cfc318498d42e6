import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TEST_SF = os.environ.get("TIDEWATER_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import get_session
    # Tests set their own checkpoint folder; on a cluster it comes from the session.
    s = get_session(master="local[*]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidewater-test-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return TEST_SF


def rows(df, *cols):
    """Collected rows as tuples (ordered by all given columns)."""
    cols = cols or tuple(df.columns)
    return [tuple(r) for r in df.select(*cols).orderBy(*cols).collect()]
