import pytest

from basketlens.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("basketlens-tests", cores="4", partitions=2)
    yield session
    session.stop()
