import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siltbed.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("shared")
    session = local_session(
        8,
        "siltbed-tests",
        spark__checkpoint__dir=f"{base}/scratch",
        spark__sql__warehouse__dir=f"{base}/warehouse",
    )
    yield session
    session.stop()


@pytest.fixture
def home(tmp_path):
    return str(tmp_path)
