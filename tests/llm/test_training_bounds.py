"""What quality training learns from when ids repeat, labels contradict, or tables are empty."""

import numpy as np
import pytest
from llm_cases import AWKWARD

from lakeload.llm import decontam, quality


@pytest.fixture
def fitted(monkeypatch):
    seen, real = [], quality.fit

    def fit(features, begins, labels):
        seen.append((len(begins) - 1, labels.tolist(), features))
        return real(features, begins, labels)

    monkeypatch.setattr(quality, "fit", fit)
    return seen


def marks(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def learned(n):
    """The first ids outside the held-out third."""
    import zlib

    return [i for i in range(10 * n) if zlib.crc32(str(i).encode()) % 3 != 1][:n]


def test_many_documents_of_one_id_are_one_bag(spark, documents, fitted):
    a, b, c = learned(3)
    rows = [(a, f"text {i} of the same id") for i in range(5_000)] + [(b, "another text"), (c, "a third text")]
    quality.train(documents(rows), marks(spark, [(a, 1, 0), (b, 0, 0), (c, 1, 0)]), rows=2)
    assert fitted[0][0] == 2
    quality.train(documents(rows[::-1]), marks(spark, [(c, 1, 0), (b, 0, 0), (a, 1, 0)]), rows=3)
    quality.train(documents(rows), marks(spark, [(a, 1, 0), (b, 0, 0), (c, 1, 0)]), rows=3)
    assert fitted[1][0] == fitted[2][0] == 3 and fitted[1][1] == fitted[2][1] == [1, 0, 1]
    assert np.array_equal(fitted[1][2], fitted[2][2])


def test_contradicting_labels_are_not_learned_from_and_repeats_count_once(spark, documents, fitted):
    a, b, c = learned(3)
    docs = documents([(a, "one"), (b, "two"), (c, None)])
    quality.train(docs, marks(spark, [(a, 1, 0), (a, 0, 0), (b, 1, 0), (b, 1, 1), (b, None, 0), (c, 0, 0)]))
    assert fitted[0][:2] == (2, [1, 0])


def test_empty_tables_give_a_model(spark, documents):
    a, b = learned(2)
    docs, some = documents([(a, "one"), (b, "two")]), marks(spark, [(a, 1, 0), (b, 0, 0)])
    for d, m in ((documents([]), some), (docs, marks(spark, [])), (documents([]), marks(spark, []))):
        model = quality.train(d, m)
        assert [r.score for r in quality.score(docs, model).collect()] == [0.5, 0.5]


def test_awkward_rows_are_trained_on_and_filtered(spark, documents):
    docs = documents(AWKWARD)
    model = quality.train(docs, marks(spark, [(i, i % 2, 0) for i in range(-5, 20)]))
    kept = quality.accepted(docs, model)
    scores = quality.score(docs, model).collect()
    assert len(scores) == len(AWKWARD) and kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in scores)


def test_benchmark_passages_in_awkward_rows(spark, documents):
    """A very long text, repeated rows, null ids and odd characters; items that are null, blank or repeated."""
    cat = AWKWARD[8][1]
    items = [(1, cat), (1, cat), (2, None), (3, " "), (4, AWKWARD[10][1]), (None, "only a null id")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [*AWKWARD, (5, cat), (20, "so it goes " * 20_000 + cat)]
    docs = documents(rows)
    found = sorted(((r.doc_id, r.item_id, r.similarity) for r in decontam.leaks(docs, benchmark).collect()), key=str)
    assert found == sorted([(5, 1, 1.0), (5, 1, 1.0), (6, 1, 1.0), (20, 1, 1.0), (7, 4, 1.0), (None, None, 1.0)], key=str)
    kept = decontam.clean(docs, benchmark)
    leaking = {cat, AWKWARD[10][1], "only a null id", rows[-1][1]}
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.text for r in kept.collect()))) == sorted(str(t) for _, t in rows if t not in leaking)
    assert decontam.clean(docs, benchmark.limit(0)).count() == len(rows)
    assert decontam.clean(documents([]), benchmark).count() == decontam.leaks(documents([]), benchmark).count() == 0
