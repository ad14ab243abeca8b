import pytest

from cohortwise.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "4g")
    yield session
    session.stop()
