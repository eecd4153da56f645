import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from evidara.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=8, memory="8g")
    yield session
    session.stop()
