import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from bvengine.session import local_session

    s = local_session("*", app="bvengine-tests", extra={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()
