import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from docweave.session import get_spark

    s = get_spark(
        "local[*]",
        app="docweave-tests",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            # tests have no cluster checkpoint folder: use a private one
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="docweave-test-ckpt-"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="docweave-test-")
