import pytest

from factloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", 4)
    yield session
    session.stop()
