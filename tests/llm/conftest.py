import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, ord int, row string, spots string, th string, kept string, label int"


@pytest.fixture
def documents(spark):
    """Documents of (id, text) rows with further columns whose names operators use for themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "r", "s", "t", "k", 0) for i, t in rows], DOCUMENTS)

    return make
