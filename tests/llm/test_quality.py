from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tallyline.llm import quality, queries
from tallyline.llm.tokens import texts_of
from tests.llm import brute


def test_measures_equal_brute_force(documents):
    rows = {r["doc_id"]: r for r in quality.quality_rules(documents).collect()}
    for doc in documents.collect():
        want, got = brute.repetition(doc["text"]), rows[doc["doc_id"]]
        assert {k: got[k] for k in want} == want
        assert got["kept"] == brute.kept(doc["text"])


def test_odd_rows(odd_documents):
    rows = quality.quality_rules(odd_documents).collect()
    assert len(rows) == 10
    assert sorted(r["n_words"] for r in rows) == [0, 0, 0, 2, 3, 3, 3, 3, 90, 40_000]
    assert all(r["base_failed"] for r in rows if r["n_words"] < 20)
    kept = quality.keep_good(odd_documents)
    assert kept.columns == odd_documents.columns
    assert [r["doc_id"] for r in kept.collect()] == [5]


def test_empty_table(documents):
    assert quality.quality_rules(documents.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", " ", "\n\n", "a", "a\na\na", "x " * 30, "é\té", "a b c d e f g h a b c d e f g h i"])
def test_small_texts(text):
    found = quality.measures(texts_of(pa.array([text, text])), [5, 6, 7, 8, 9, 10])
    want = brute.repetition(text)
    for name, value in want.items():
        assert list(found[name]) == [value, value], name


def test_equal_words_of_neighbouring_texts_are_no_repeats():
    line = "one two three four five six seven eight nine ten"
    found = quality.measures(texts_of(pa.array([line, line, line])), [5, 10])
    assert not np.any(found["dup_chars_5"]) and not np.any(found["n_dup_lines"])


CLEAN = {
    "list": "\n".join(f"* {a} {b}" for a, b in zip("pears plums figs dates limes beans peas leeks kale mint".split(), "ripe dry new old big raw hot sweet green cold".split())),
    "table": "\n".join(f"| row {i} | {a} | {i * 37 % 101} |" for i, a in enumerate("ash oak elm fir yew bay box may haw sloe pine larch".split())),
    "code": "\n".join(f"if (a[{i}] & {1 << i}) > {w}[{i}] && !{w} {{ x += y[{i * 3}] | {i * 7}; }}" for i, w in enumerate("sum cut low top end mid key".split())),
}


@pytest.mark.parametrize("name", sorted(CLEAN))
def test_marks_alone_do_not_reject(spark, name):
    docs = spark.createDataFrame([(1, CLEAN[name])], "doc_id long, text string")
    row = quality.quality_rules(docs).first()
    assert 100 * row["n_symbols"] > 10 * row["n_words"] and not row["base_failed"]
    assert row["kept"] and brute.kept(CLEAN[name])


def test_the_query_also_judges_marks(spark, tmp_path):
    """More than 10 symbols per hundred words fail a document, 10 do not."""
    plain = " ".join(f"word{i}" for i in range(20))
    texts = {"none": plain, "at the limit": f"{plain} #*", "above": f"{plain} #*$", **CLEAN}
    spark.createDataFrame(list(texts.items()), "doc_id string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_quality_rules"](spark, str(tmp_path)).collect()}
    assert {name for name, r in rows.items() if r["kept"]} == {"none", "at the limit"}
    assert not any(r["base_failed"] for r in rows.values())
