import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cinerank.session import get_session

    ckpt = tempfile.mkdtemp(prefix="cinerank-test-ckpt-")
    s = get_session(
        "local[4]",
        conf={"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.checkpoint.dir": ckpt},
    )
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="cinerank-test-")
