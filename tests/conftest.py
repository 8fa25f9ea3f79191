import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    from lotloom.session import local_session

    session = local_session(partitions=8)
    yield session
    session.stop()
