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
    from lodgespark.session import build_session
    ckpt = tempfile.mkdtemp(prefix="lodgespark-test-ckpt-")
    s = build_session("local[*]", app="lodgespark-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    from lodgespark.session import clean_scratch
    clean_scratch(s)
    s.stop()
