import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from lahar.session import build_session

    return build_session("tests", spark__sql__shuffle__partitions="4", spark__driver__host="127.0.0.1")
