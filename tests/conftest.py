import pytest

from labelgap.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4, memory="8g")
    yield session
    session.stop()
