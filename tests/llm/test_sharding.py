from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from tallyline.llm import sharding


def by_shard(rows):
    out = {}
    for r in rows:
        out.setdefault(r["shard"], []).append(r)
    return out


def check_slots(rows):
    for held in by_shard(rows).values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))


def test_shards_of_the_table(documents):
    rows = sharding.shard_documents(documents, carry=False).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    check_slots(rows)
    sizes = [sum(r["size"] for r in held) for held in by_shard(rows).values()]
    assert len(sizes) == 8
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
    again = sharding.shard_documents(documents.repartition(5), carry=False).collect()
    assert sorted(again) == sorted(rows)


def test_copies_stay_together_but_a_hot_group_is_spread(spark):
    rows = [(i, f"text {i // 4} " + "x" * 100) for i in range(2000)] + [(10_000 + i, "hot " * 30) for i in range(1000)]
    placed = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), parts=4).collect()
    check_slots(placed)
    sizes = [sum(r["size"] for r in held) for held in by_shard(placed).values()]
    assert max(sizes) <= 1.03 * min(sizes)
    groups, hot = {}, set()
    for r in placed:
        (hot.add(r["shard"]) if r["doc_id"] >= 10_000 else groups.setdefault(r["row"]["text"], set()).add(r["shard"]))
    assert len(hot) >= 3
    assert sum(len(s) > 1 for s in groups.values()) == 0


def test_exact_counts_below_boundaries(documents):
    keyed = documents.select(sharding.sort_key(F.col("text"), F.col("doc_id")).alias("key"), sharding.byte_size(F.col("text")).alias("size"))
    rows = sorted(tuple(r) for r in keyed.collect())
    probes = sharding.np.array([0, rows[10][0], rows[10][0] + 1, rows[-1][0], sharding.KEY_END - 1], sharding.np.int64)
    below, n = sharding.count_below(keyed, probes)
    for i, probe in enumerate(probes):
        assert (below[i], n[i]) == (sum(s for k, s in rows if k < probe), sum(k < probe for k, _ in rows))


def test_odd_rows(odd_documents):
    placed = sharding.shard_documents(odd_documents)
    rows = placed.collect()
    assert len(rows) == 10
    check_slots(rows)
    assert sorted(r["row"]["row"] for r in rows) == [f"r{i}" for i in range(10)]
    assert {r["size"] for r in rows if not r["row"]["text"]} == {1}


@pytest.mark.parametrize("low, high", [(0, 1), (0, 2), (5, 100), (0, sharding.KEY_END), (3 << 31, (3 << 31) + 9), (7, (1 << 31) + 1)])
def test_candidates_lie_between(low, high):
    found = sharding.candidates(low, high)
    assert all(low < c < high for c in found) and (found or high - low <= 1)


def test_empty_table(documents):
    assert sharding.shard_documents(documents.limit(0)).count() == 0


def test_parts_grow_with_the_table(spark, monkeypatch):
    """Far more parts than by default, and more than there are rows in some of them: the same law holds."""
    monkeypatch.setattr(sharding, "PART_BYTES", 200)
    asked = []
    search = sharding.find_splitters
    monkeypatch.setattr(sharding, "find_splitters", lambda keyed, total, shards, parts, t: asked.append(parts) or search(keyed, total, shards, parts, t))
    rows = [(i, f"text {i} " + "x" * (i % 150)) for i in range(2000)]
    placed = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert asked[0] > 50 and len(placed) == 2000
    check_slots(placed)
    sizes = [sum(r["size"] for r in held) for held in by_shard(placed).values()]
    share = sum(sizes) / 8  # each end of a shard is within the tolerance of its place
    assert len(sizes) == 8 and max(abs(size - share) for size in sizes) <= 2 * sharding.TOLERANCE * share + 1
    order = lambda placed: [r["doc_id"] for r in sorted(placed, key=lambda r: (r["shard"], r["slot"]))]
    one = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), parts=1).collect()
    assert order(placed) == order(one)


def test_null_texts_as_a_hot_group(spark):
    """A third of all rows without a text: one byte each, in as many shards as the law of equal bytes asks for."""
    rows = [(i, None if i % 3 == 0 else f"text {i} " * 5) for i in range(3_000)]
    placed = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), carry=False).collect()
    check_slots(placed)
    assert len(placed) == 3_000 and {(r["size"], r["text_crc32"]) for r in placed if r["doc_id"] % 3 == 0} == {(1, 0)}
    sizes = [sum(r["size"] for r in held) for held in by_shard(placed).values()]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in placed) + sum(sizes) // 8 // 100


@pytest.mark.parametrize("copies, cuts", [(20, (7, 8, 9)), (2_000, (40,))])
def test_a_group_is_divided_only_beyond_a_hundredth_of_a_shard(spark, copies, cuts):
    """20 copies are less than a hundredth of an eighth of all bytes; 2,000 are more than a fortieth of them."""
    rows = [(i, f"text {i} " * 12) for i in range(20_000)] + [(100_000 + i, "one text here " * 6) for i in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for shards in cuts:
        placed = sharding.shard_documents(docs, shards, carry=False).where("doc_id >= 100000").collect()
        held = len({r["shard"] for r in placed})
        assert held == 1 if copies == 20 else held >= 3
