import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from attrition.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = get_spark(master="local[4]", shuffle_partitions=8, extra_conf={"spark.checkpoint.dir": scratch})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
