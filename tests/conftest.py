import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cardspark.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="cardspark-tests",
                      extra={"spark.driver.memory": "6g"})
    yield s
    s.stop()
