import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from twinledger.session import session

    s = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-")})
    s.sparkContext.setLogLevel("ERROR")
    return s
