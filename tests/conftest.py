import os

import pytest

from logfreight.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("LOGFREIGHT_DATA", "/root/testdata/sf0.001")
