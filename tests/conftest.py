import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from candlewick.session import build_session
    s = build_session("local[4]", 4, app_name="candlewick-tests",
                      extra={"spark.cleaner.referenceTracking.cleanCheckpoints": "true",
           "spark.checkpoint.dir": os.environ.get("SPARK_CHECKPOINT_DIR")
                             or tempfile.mkdtemp(prefix="cw-tests-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cw-test-")
