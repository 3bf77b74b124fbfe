import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("BENCH_CPUS", "4")
    from pagliaio.session import build_session

    session = build_session("tests", **{"spark.driver.memory": "4g"})
    yield session
    session.stop()
