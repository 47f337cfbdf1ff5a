import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from fieldmart.session import get_session

    s = get_session("local[4]", shuffle_partitions=8, app_name="fieldmart-tests",
                    extra={"spark.driver.memory": "8g"})
    yield s
    from fieldmart.session import release_materialized

    release_materialized(s)
    s.stop()


@pytest.fixture
def tmp_root(tmp_path):
    return str(tmp_path)
