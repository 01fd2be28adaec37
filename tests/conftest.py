import pytest

from corpusloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 4)
    session.sparkContext.setLogLevel("OFF")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()
