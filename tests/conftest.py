import pytest

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, app="tests")
    yield session
    session.stop()
