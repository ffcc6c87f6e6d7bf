import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tables import SF  # noqa: E402

from textgauge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
