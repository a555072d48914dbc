"""The pipeline's stages, each on what its predecessor kept, against brute force; the numbered queries on the given tables."""

import collections

import pytest
from test_operators import grouped, leaking, without_repeats

import corpus_pipeline
from lakeload.llm import suite

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage gives, written and reread as the pipeline does."""
    out, docs = {"documents": spark.read.parquet(f"{SF}/documents.parquet")}, spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_keep_the_columns_and_only_take_away(kept):
    names = [n for n, _ in corpus_pipeline.STAGES]
    before = "documents"
    for name in names[:-1]:
        assert kept[name].columns == COLUMNS and kept[name].dtypes == kept["documents"].dtypes
        ids = {r.doc_id for r in kept[name].select("doc_id").collect()}
        assert ids <= {r.doc_id for r in kept[before].select("doc_id").collect()}
        before = name


def test_quality_rejects_junk_and_keeps_clean_text(spark, kept):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    there = {d for d, _ in rows(kept["quality_classifier"])}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in there for d in good) >= 0.9 * len(good) and sum(d in there for d in bad) <= 0.3 * len(bad)


def test_one_document_of_each_group_stays(kept):
    given = rows(kept["quality_classifier"])
    assert {d for d, _ in rows(kept["minhash_near_dedup"])} == {d for d, g in grouped(given).items() if g[2]}


def test_repeated_strings_are_cut(kept):
    given = sorted(rows(kept["minhash_near_dedup"]))
    after = dict(rows(kept["suffix_array_dedup"]))
    for doc, size, removed, _, _ in without_repeats(given):
        left = len(after[doc].encode())
        assert size - removed - 6 <= left <= size - removed  # a cut may leave parts of characters, which go too
    assert all(r.n_chars == len(r.text) for r in kept["suffix_array_dedup"].collect())


def test_leaking_documents_go_and_others_stay(spark, kept):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    given = rows(kept["suffix_array_dedup"])
    leaks = {d for d, _ in leaking(given, items)}
    assert {d for d, _ in rows(kept["benchmark_decontamination"])} == {d for d, _ in given} - leaks


def test_every_document_that_is_left_is_packed(kept):
    packed = kept["best_fit_packing"].collect()
    assert {r.doc_id for r in packed} == {d for d, _ in rows(kept["benchmark_decontamination"])}
    filled = collections.Counter()
    for r in packed:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048 and len(filled) <= -(-sum(filled.values()) // 2048) * 1.1 + 1


def test_the_pipeline_has_no_step_of_its_own(spark, kept):
    whole = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert whole == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in kept["best_fit_packing"].collect())


@pytest.mark.parametrize("key", sorted(k for k, (_, sql) in suite.KEYS.items() if sql))
def test_queries_agree_with_their_sql(spark, key):
    from check import run

    df, verdict, _ = run(spark, SF, key)
    assert verdict.startswith("ok") and "types" not in verdict, verdict


@pytest.mark.parametrize("key", ["op1_chat_snapshots", "op3_url_trees", "op5_spot_signatures"])
def test_native_operators_stay_in_the_jvm(spark, key):
    plan = suite.KEYS[key][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node
