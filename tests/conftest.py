import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lodestone.session import build_session, ship

    s = build_session("local[8]", 4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
