import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quipu.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session("quipu-tests", cores=8, memory="8g", spark__checkpoint__dir=str(shared))
    yield session
    session.stop()
