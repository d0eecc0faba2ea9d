import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from edflux.session import build_session

    scratch = tempfile.mkdtemp(prefix="edflux-tests-")
    s = build_session(
        "local[4]",
        app_name="edflux-tests",
        shuffle_partitions=4,
        extra_conf={
            "spark.local.dir": scratch,
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="edflux-case-")
