import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakeload.session import build  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build("tests", 4, 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(spark, tmp_path):
    return str(tmp_path)
