import tempfile

import pytest

from custodia.session import CHECKPOINT_CONF, local_session

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="custodia-test-")
    session = local_session("tests", "4", {CHECKPOINT_CONF: shared})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def base():
    return BASE
