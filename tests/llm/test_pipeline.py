"""The pipeline's stages, each against a plain version on its own input."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from tallyline.llm import mixing
from tallyline.session import materialize
from tests.llm import brute


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"test-{name}")
        out.append(docs)
    return out


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_stages_call_the_dealt_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_columns_are_those_of_documents(results):
    assert all(frame.columns == results[0].columns for frame in results[:-1])
    assert results[-1].columns == [*results[0].columns, "shard", "slot"]


def test_quality_stage(results):
    assert ids(results[1]) == sorted(r["doc_id"] for r in results[0].collect() if brute.kept(r["text"]))


def test_near_duplicate_stage(results):
    docs = results[1].orderBy("doc_id").collect()
    label = brute.classes(len(docs), brute.near_links([d["text"] for d in docs]))
    assert ids(results[2]) == sorted({docs[i]["doc_id"] for i in label})


def test_decontamination_stage(results, spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    want = [d["doc_id"] for d in results[2].collect() if not any(brute.leaks(d["text"], i["text"]) for i in items if three(d["text"], i["text"]))]
    assert ids(results[3]) == sorted(want)


def three(text, item):
    grams = [set(zip(*(brute.plain(t)[k:] for k in range(3)))) for t in (text, item)]
    return bool(grams[0] & grams[1])


def test_mixing_stage(results):
    mix = {r["doc_id"]: round(r["taken"] / r["size"] + 1e-9) for r in mixing.mix_sources(results[3]).collect() if r["size"]}
    assert ids(results[4]) == sorted(doc for doc, times in mix.items() for _ in range(times))


def test_sharding_stage(results):
    rows = results[5].collect()
    assert ids(results[5]) == ids(results[4])
    for shard in range(8):
        held = [r["slot"] for r in rows if r["shard"] == shard]
        assert sorted(held) == list(range(len(held)))


def test_run_gives_the_last_stage(results, spark, sf_dir):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, results[-1].collect()))


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_on_odd_and_empty_tables(spark, sf_dir, odd_documents, rows):
    docs = odd_documents if rows == "odd" else odd_documents.limit(0)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = materialize(stage(spark, docs, sf_dir), f"odd-{name}")
        assert re.match("doc_id", found.columns[0])
        if number < 4:
            assert found.columns == docs.columns
        assert found.count() <= max(10, 3 * docs.count())
