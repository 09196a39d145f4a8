import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    s = get_session("local[4]", app="tessera-tests", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()
