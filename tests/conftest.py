import pytest

from barpath.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", memory="4g", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
