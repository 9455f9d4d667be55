import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lanewatch.session import get_session
    s = get_session("local[*]", app="lanewatch-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lanewatch-test-ckpt-")})
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
