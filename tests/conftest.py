import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from custlens.session import get_session
    ckpt = tempfile.mkdtemp(prefix="custlens-test-ckpt-")
    s = get_session("local[4]", "custlens-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
