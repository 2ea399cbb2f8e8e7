import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wattfold.session import local_session

    root = tmp_path_factory.mktemp("spark")
    session = local_session(4, "tests", spark__sql__warehouse__dir=str(root / "warehouse"), spark__checkpoint__dir=str(root / "shared"))
    yield session
    session.stop()
