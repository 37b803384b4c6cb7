import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ramure.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[*]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                            spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
                            spark__default__parallelism="4", spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="ramure-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
