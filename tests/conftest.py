import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vetline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Tests own their shared folder (a cluster names it in spark.checkpoint.dir).
    root = tempfile.mkdtemp(prefix="vetline-tests-")
    session = build_session("local[4]", app_name="vetline-tests", shuffle_partitions=4,
                            extra={"spark.checkpoint.dir": root})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tmp_root(spark):
    from vetline.session import scratch_path
    return scratch_path(spark, "test")
