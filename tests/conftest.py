import os
import sys
from pathlib import Path

import pytest

for folder in (Path(__file__).resolve().parents[1], Path(__file__).resolve().parent):
    sys.path.insert(0, str(folder))
    os.environ["PYTHONPATH"] = f"{folder}:{os.environ.get('PYTHONPATH', '')}"  # for Spark's Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from weftline.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__warehouse__dir=f"file://{folder}/warehouse",
        spark__checkpoint__dir=f"file://{folder}/checkpoints", spark__sql__session__timeZone="UTC", spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
