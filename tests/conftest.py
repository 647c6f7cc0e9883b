import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rill.session import get_session

    # tests own their session, so they pick the checkpoint folder when unset
    extra = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="rill-test-ckpt-"),
             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="rill-test-wh-")}
    s = get_session("local[*]", 8, app_name="rill-tests", extra=extra)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rill-test-")
