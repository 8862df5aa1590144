"""The registered text queries, and the pipeline stage by stage on the small tables."""

import os
import zlib

import __spark_entry__ as contract
import corpus_pipeline
import pytest
from furrow.llm import bpe, decontaminate, queries, toxicity
from test_models_of_text import leaks_by_hand
from test_native import lines_by_hand
from test_near_dedup import brute_force


@pytest.fixture(scope="module")
def stages(spark):
    sf_dir = f"{corpus_dir()}/sf0.001"
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), f"test-{name}")
        out.append(docs)
    return sf_dir, out


def corpus_dir():
    return os.environ.get("FURROW_TESTDATA", "/root/testdata")


def test_registered():
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in names if name.startswith("op")}
    assert "pipeline" in names and set(queries.SQL) <= set(queries.REGISTRY)


def test_columns_stay(stages):
    _, frames = stages
    assert all(frame.dtypes == frames[0].dtypes for frame in frames[:-1])
    assert frames[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_toxic_rows_go(spark, stages):
    sf_dir, frames = stages
    kept = {r.doc_id for r in frames[1].collect()}
    before = frames[0]
    model = toxicity.train(before, spark.read.parquet(f"{sf_dir}/labels.parquet"), toxicity.learnable())
    scores = {r.doc_id: r.toxicity for r in toxicity.score(before, model).collect()}
    assert kept == {d for d, s in scores.items() if s < toxicity.THRESHOLD}


def test_lines(stages):
    _, frames = stages
    before = [(r.doc_id, r.text) for r in frames[1].collect()]
    expected = lines_by_hand(before)
    after = {r.doc_id: r for r in frames[2].collect()}
    texts = dict(before)
    assert set(after) == {d for d, t in expected.items() if t == texts[d] or (t or "").strip(" ")}
    assert all(r.text == expected[d] for d, r in after.items())
    assert all(r.n_chars == len(r.text) for r in after.values() if r.text != texts[r.doc_id])


def test_near_duplicates(stages):
    _, frames = stages
    before = [(r.doc_id, r.text) for r in frames[2].collect()]
    expected = {d for d, (_, least) in brute_force(before, 5, 80).items() if d == least}
    assert {r.doc_id for r in frames[3].collect()} == expected


def test_leaks_go_and_clean_rows_stay(spark, stages):
    sf_dir, frames = stages
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in frames[4].collect()}
    for row in frames[3].collect():
        share = max(leaks_by_hand(row.text or "", item) for item in items)
        assert (row.doc_id in kept) or share >= decontaminate.SHARE - 0.2
        assert share < 0.6 or row.doc_id not in kept


def test_tokens(stages):
    _, frames = stages
    path, pattern = queries.vocabulary()
    codec = bpe.Codec(bpe.read_ranks(path), pattern)
    texts = {r.doc_id: r.text or "" for r in frames[4].collect()}
    found = frames[5].collect()
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        assert codec.decode(codec.encode(texts[r.doc_id])) == texts[r.doc_id].encode()
        assert r.n_tokens == len(codec.encode(texts[r.doc_id]))


def test_language_on_held_out_rows(spark):
    sf_dir = f"{corpus_dir()}/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    found = queries.op5_language(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    right = [r.lang_pred == langs[r.doc_id] for r in found if r.held_out]
    assert sum(right) / len(right) > 0.97


def test_class_model_beats_the_base_on_held_out_rows(spark):
    found = [r for r in queries.op7_class_lm(spark, f"{corpus_dir()}/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
