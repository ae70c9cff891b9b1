from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from groundsill.session import build_session  # noqa: E402

# Started on import, because test modules build column expressions when they are loaded.
SESSION = build_session(
    "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
    spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()
