import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from courtloom.session import session  # noqa: E402

SAMPLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8"}
    spark = session("local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
