import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from changelake.session import build_session

    s = build_session("local[4]", app="changelake-tests", spark__sql__shuffle__partitions="8")
    yield s
    s.stop()
