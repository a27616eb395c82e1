import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martwright.session import build_session
    s = build_session("local[4]", app_name="martwright-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def src_small(spark):
    from martwright.sources.fixtures import Sources
    return Sources(spark, SF_SMALL)
