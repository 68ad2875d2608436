import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from finsight.session import build_session
    scratch = tempfile.mkdtemp(prefix="finsight-tests-")
    s = build_session("local[4]", 8, app_name="finsight-tests",
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.local.dir": os.path.join(scratch, "local"),
                             "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
                             "spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="finsight-t-")
