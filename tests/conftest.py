import pytest

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session("tidemark-tests", cpus=4, shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    return s
