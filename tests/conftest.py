import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from chatterscope.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="tests", memory="6g")
    yield session
    session.stop()
