import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tideline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tideline-tests", master="local[4]", spark__sql__shuffle__partitions=2,
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sample_dir():
    return "/root/testdata/sf0.001"
