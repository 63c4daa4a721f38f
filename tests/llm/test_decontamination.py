from __future__ import annotations

import itertools

import pytest

import corpus_pipeline
from tallyline.llm import decontamination as dc
from tallyline.llm import queries
from tests.llm import brute


def leaked(found):
    return {(r["doc_id"], r["item_id"]) for r in found.collect()}


def test_leaks_equal_brute_force(spark, sf_dir, documents):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = benchmark.collect()
    common = [set(zip(*(brute.plain(i["text"])[k:] for k in range(3)))) for i in items]
    want = set()
    for doc in documents.collect():
        grams = set(zip(*(brute.plain(doc["text"])[k:] for k in range(3))))
        for item, own in zip(items, common):
            if grams & own and brute.leaks(doc["text"], item["text"]):  # 11 of 13 equal words leave three in a row
                want.add((doc["doc_id"], item["item_id"]))
    assert leaked(dc.find_leaks(documents, benchmark)) == want and want


def test_masks_find_every_two_substitutions():
    for wrong in itertools.combinations(range(dc.STRETCH), 2):
        assert any(
            all(not (0 <= w - at < len(mask) and mask[w - at] == "1") for w in wrong)
            for mask in dc.MASKS
            for at in range(dc.STRETCH - len(mask) + 1)
        ), wrong


@pytest.mark.parametrize("length", range(1, dc.STRETCH + 1))
def test_every_length_is_found_with_every_substitution_that_counts(spark, length):
    """An item of each length, whole and with each one or two words replaced that leave 80 % of it."""
    item = [f"i{k}" for k in range(length)]
    wrongs = [(), *((k,) for k in range(length)), *itertools.combinations(range(length), 2)]
    docs = [(n, " ".join(["before", *("x" if k in w else item[k] for k in range(length)), "after"])) for n, w in enumerate(wrongs)]
    # a whole item below the span of a mask, 80 % from there on
    want = {n for n, w in enumerate(wrongs) if (not w if length < 10 else 100 * (length - len(w)) >= 80 * length)}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = dc.find_leaks(frame, items, shortest=1).collect()
    assert {r["doc_id"] for r in found} == want
    assert {(r["matched"], r["first_word"], r["n_words"]) for r in found if r["doc_id"] == 0} == {(length, 1, length)}


def test_scripts_without_spaces(spark):
    docs = [(1, "问：法国的首都是哪里？答：巴黎。"), (2, "法国的首都"), (3, "ab ประเทศไทย cd"), (4, "𠀀𠀁x")]
    items = [(1, "法国的首都是哪里"), (2, "ประเทศ"), (3, "𠀁 x")]
    found = dc.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), shortest=1
    )
    assert leaked(found) == {(1, 1), (3, 2), (4, 3)}


def test_pipeline_and_query_drop_a_short_leak(spark, tmp_path):
    docs = [(1, "so: What is the capital of France? Paris"), (2, "what is the capital of Spain"), (3, "yes yes no yes")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, "What is the capital of France?"), (2, "Yes.")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op7_benchmark_decontamination(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["item_id"], r["first_word"]) for r in got} == {(1, 1, 1), (3, 2, 3)}
    kept = corpus_pipeline.remove_leaks(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert [r["doc_id"] for r in kept.collect()] == [2]


def test_substituted_recased_and_clean(spark):
    item = "The quick brown fox jumps over the lazy dog while seven wizards quietly brew potions under a pale moon"
    swapped = item.split()
    swapped[4] = swapped[11] = "REPLACED"
    docs = [
        (1, f"before {item.upper()} after"),
        (2, "before, " + " ".join(swapped)),
        (3, "the quick brown fox is a film about seven wizards under a moon and other matters of taste"),
        (4, " ".join(reversed(item.split()))),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (5, item), (9, "the quick brown fox"), (None, None)], "item_id long, text string")
    found = dc.find_leaks(docs, items)
    assert leaked(found) == {(1, 5), (2, 5)}
    assert {r["n_items"] for r in found.collect()} == {2}
    assert [r["doc_id"] for r in dc.drop_leaked(docs, found).orderBy("doc_id").collect()] == [3, 4]


def test_leaks_beyond_the_broadcast_size_are_joined_by_a_shuffle(spark, monkeypatch, odd_documents):
    leaks = spark.createDataFrame([(3, "one two three"), (None, "one two three"), (4, "other")], "doc_id long, text string")
    leaks = leaks.selectExpr("doc_id", "md5(text) AS doc", "1L AS item_id")
    left = {}
    for most in (dc.BROADCAST_LEAKS, 2):
        monkeypatch.setattr(dc, "BROADCAST_LEAKS", most)
        kept = dc.drop_leaked(odd_documents, leaks)
        left[most] = sorted(map(repr, kept.collect()))
        hinted = "strategy=broadcast" in kept._jdf.queryExecution().optimizedPlan().toString()
        assert hinted == (most > 2)
    first, second = left.values()
    assert first == second and len(first) == 7


def test_filter_size_does_not_matter(spark, sf_dir, documents):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert leaked(dc.find_leaks(documents, benchmark, filter_size=1 << 14)) == leaked(dc.find_leaks(documents, benchmark))


@pytest.mark.parametrize("side", ["docs", "items"])
def test_empty_tables(spark, documents, side):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id long, text string")
    docs, items = (documents.limit(0), items) if side == "docs" else (documents, items.limit(0))
    assert dc.find_leaks(docs, items).count() == 0


def test_odd_rows(spark, odd_documents):
    long_text = odd_documents.where("doc_id = 5").first()["text"].split()
    items = spark.createDataFrame([(1, " ".join(long_text[-30:])), (2, None), (3, "")], "item_id long, text string")
    found = dc.find_leaks(odd_documents, items)
    assert leaked(found) == {(5, 1)}
    kept = dc.drop_leaked(odd_documents, found)
    assert kept.columns == odd_documents.columns and kept.count() == 9
