from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyline.llm import mixing


def water_fill(sizes: list[int], weights: list[float], cap: int = 3) -> list[float]:
    total, share = sum(sizes), [0.0] * len(sizes)
    stopped: set[int] = set()
    while True:
        left = total - sum(cap * sizes[i] for i in stopped)
        weight = sum(weights[i] for i in range(len(sizes)) if i not in stopped)
        share = [cap * sizes[i] if i in stopped else left * weights[i] / weight for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if i not in stopped and share[i] > cap * sizes[i]}
        if not over:
            return share
        stopped |= over


def highest_quotients(targets: list[float], seats: int) -> list[int]:
    won = [0] * len(targets)
    for _ in range(seats):
        best = max(range(len(targets)), key=lambda i: (targets[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


@pytest.mark.parametrize(
    "sizes",
    [[100, 200, 300], [10, 1000, 1000, 5], [1, 1, 1, 5000], [7], [0, 50, 0, 60], [3, 40, 500, 6000, 70_000, 800, 9, 10, 11]],
)
def test_targets_and_quotas(spark, sizes):
    rows = spark.createDataFrame([(i, f"s{i:02}", s) for i, s in enumerate(sizes)], "doc_id int, source string, size long")
    targets = mixing.source_targets(rows)
    want = water_fill(sizes, [i % 3 + 1 for i in range(len(sizes))])
    assert [r["target"] for r in targets.orderBy("source").collect()] == pytest.approx(want)
    for shards in (1, 8):
        quotas = mixing.shard_quotas(targets, shards, 4)
        by_shard = {(r["source"], r["shard"]): r["quota"] for r in quotas.collect()}
        so_far = [0] * len(sizes)
        for shard in range(shards):
            so_far = [n + by_shard[f"s{i:02}", shard] for i, n in enumerate(so_far)]
            assert so_far == highest_quotients(want, int(sum(want) * (shard + 1) / shards / 4 + 0.5))


def test_sources_come_near_targets_and_reruns_agree(documents):
    mix = mixing.mix_sources(documents)
    rows = mix.collect()
    assert sorted(rows) == sorted(mixing.mix_sources(documents.repartition(7)).collect())
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    by_source = mix.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    assert all(abs(r["taken"] - r["target"]) <= 16 for r in by_source.collect())


def test_shards_take_their_quotas(documents):
    """What a shard takes of a source is its quota, the last block of a line apart; shards together take the same for any number."""
    for shards in (1, 3, 8):
        mix = mixing.mix_sources(documents, shards=shards)
        rows = mix.collect()
        assert all(sum(r["shard_words"]) == r["taken"] and min(r["shard_words"]) >= 0 for r in rows)
        quotas = mixing.shard_quotas(mixing.source_targets(mix.select("doc_id", "source", "size")), shards, 16).collect()
        for quota in quotas:
            words = sum(r["shard_words"][quota["shard"]] for r in rows if r["source"] == quota["source"])
            cap = 3 * sum(r["size"] for r in rows if r["source"] == quota["source"])
            assert abs(words - 16 * quota["quota"]) <= 16 or words == cap
    held = {tuple(bool(w) for w in r["shard_words"]) for r in rows}
    assert len(held) > 8, "shards take different documents"


def test_one_repeated_id_is_spread(spark):
    """A third of all rows with one id, in part equal: equal rows are counted first, others have places of their own."""
    rows = [(i if i % 3 else 0, f"text {i if i % 2 else 'same'} " * 9, "s") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.mix_sources(docs, parts=50)
    assert mix.count() == 3_000 and mix.agg(F.sum("taken")).first()[0] == mix.agg(F.sum("size")).first()[0]
    places = docs.select(mixing.seeded(7, F.col("doc_id"), F.md5("text")).alias("p")).where("p is not null")
    largest = places.groupBy(F.floor(F.col("p") * 50 / F.lit(1 << 28))).agg(F.countDistinct("p").alias("n")).agg(F.max("n")).first()[0]
    assert largest < 120


def test_hot_source_in_many_parts_gives_the_same_mix(documents):
    hot = documents.withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.lit("hot")).otherwise(F.col("source")))
    assert sorted(mixing.mix_sources(hot, parts=1).collect()) == sorted(mixing.mix_sources(hot, parts=64).collect())


def test_odd_rows(odd_documents):
    rows = mixing.mix_sources(odd_documents, block_words=1).collect()
    assert len(rows) == 10
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    drawn = mixing.draw_mix(odd_documents)
    assert drawn.columns == odd_documents.columns
    assert all(r["text"].split() for r in drawn.collect())


def test_draw_repeats_whole_documents(documents):
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix_sources(documents).collect()}
    drawn = {r["doc_id"]: r["count"] for r in mixing.draw_mix(documents).groupBy("doc_id").count().collect()}
    for doc, (size, words) in taken.items():
        assert abs(drawn.get(doc, 0) * size - words) <= size / 2


def test_empty_table(documents):
    assert mixing.mix_sources(documents.limit(0)).count() == 0


def test_no_python_on_the_main_path(documents):
    for frame in (mixing.mix_sources(documents), mixing.draw_mix(documents)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
