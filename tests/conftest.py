import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cuelake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", 4, "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
