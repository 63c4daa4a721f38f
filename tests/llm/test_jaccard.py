from __future__ import annotations

import random

import numpy as np
import pytest

from tallyline.llm import groups, jaccard
from tests.llm import brute


def check_against_brute_force(rows, ids, texts):
    links = brute.near_links(texts)
    label = brute.classes(len(texts), links)
    degree = np.bincount([i for pair in links for i in pair], minlength=len(texts))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows}
    assert got == {ids[i]: (ids[label[i]], degree[i]) for i in range(len(texts))}


def test_all_links_of_the_table(documents):
    docs = documents.orderBy("doc_id").collect()
    rows = jaccard.jaccard_join(documents).collect()
    check_against_brute_force(rows, [d["doc_id"] for d in docs], [d["text"] for d in docs])


def test_crowded_group_of_near_copies_in_blocks(spark, monkeypatch):
    """More near copies than a block holds: no link is lost or counted twice."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    texts = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(len(own))] = f"x{i}"
        texts.append(" ".join(own))
    rows = jaccard.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    check_against_brute_force(rows, list(range(len(texts))), texts)


def test_few_long_near_copies_that_leave_blocks_empty(spark, monkeypatch):
    """A prefix cut by weight into more blocks than it has texts: the groups with an empty block have no pairs."""
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 120)
    texts = [" ".join([*(f"w{i}.{k}" for k in range(119)), f"x{j}"]) for i in range(8) for j in range(3)]
    rows = jaccard.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    check_against_brute_force(rows, list(range(len(texts))), texts)
    assert {r["n_linked_texts"] for r in rows} == {2}


def test_odd_rows(odd_documents):
    rows = jaccard.jaccard_join(odd_documents).collect()
    assert len(rows) == 10
    three = [r for r in rows if r["n_copies"] == 4]
    assert [r["class_id"] for r in three] == [3] * 4 and [r["n_links"] for r in three] == [3] * 4
    assert all(r["n_links"] == 0 for r in rows if r["class_key"] is None)
    assert {r["class_id"] for r in rows if r["doc_id"] in (1, 2)} == {1, 2}
    kept = jaccard.keep_one_per_class(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, 1), (False, 2), (False, 3), (False, 5), (False, 6), (False, 7), (True, 0)
    ]


def test_empty_table(documents):
    assert jaccard.jaccard_join(documents.limit(0)).count() == 0


def test_shorter_prefixes_reach_the_target_in_fewer_trees():
    plan = jaccard.prefix_trees(80, 0.9999)
    assert plan == {6: 34, 5: 26, 4: 20}
    for length, trees in plan.items():
        assert (1 - 0.8**length) ** trees <= 0.0001 / 3 < (1 - 0.8**length) ** (trees - 1)
    assert jaccard.first_places(plan) == {6: 0, 5: 34, 4: 60}
    assert jaccard.prefix_trees(50, 0.9999) == {2: 36, 1: 15}
    assert jaccard.prefix_trees(100, 0.9999) == {16: 1, 15: 1, 14: 1}


def test_recall_of_each_length_at_the_threshold():
    """3,000 pairs of sets with a similarity of exactly 0.8: every length finds them by itself."""
    pairs, plan = 3000, jaccard.prefix_trees(80, 0.9999)
    rng = np.random.default_rng(5)
    sets = rng.integers(0, 1 << 63, (pairs, 100), np.uint64)
    value = np.concatenate([np.stack([sets[:, :90], sets[:, 10:]], 1).reshape(-1)])
    offsets = np.arange(2 * pairs + 1) * 90
    for length, trees in plan.items():
        keys = jaccard.tree_keys(value, offsets, plan, [length]).reshape(pairs, 2, trees)
        assert (keys[:, 0] == keys[:, 1]).any(1).mean() >= 0.999


def texts_with_a_common_passage(n: int, rng: random.Random) -> list[str]:
    """Different texts of which about half is one passage, so that they are less alike than the threshold."""
    passage = [f"p{i}" for i in range(60)]
    return [" ".join([*passage, *(f"w{i}.{rng.randrange(10**6)}" for _ in range(30))]) for i in range(n)]


def test_the_length_depends_on_whom_a_text_meets(spark, monkeypatch):
    """Texts in a crowd that are not alike take long prefixes, a lone pair and the near copies of a cluster short ones."""
    monkeypatch.setattr(jaccard, "CROWD", 20)
    rng = random.Random(11)
    texts = texts_with_a_common_passage(60, rng)
    texts += [texts[0] + " more", " ".join(f"a{i}" for i in range(90)), " ".join(f"a{i}" for i in range(91))]
    docs = spark.createDataFrame([(i, str(i), t) for i, t in enumerate(texts)], "doc_id long, text_key string, text string")
    plan = jaccard.prefix_trees(80, 0.9999)
    nodes = jaccard.shared_nodes(jaccard.signatures(docs, 5, plan, list(plan)))
    taken = {int(r["text_key"]): r["length"] for r in jaccard.chosen_lengths(nodes, plan).collect()}
    assert taken[61] == taken[62] == 4
    assert sum(taken.get(i) == 6 for i in range(60)) > 40
    rows = jaccard.jaccard_join(docs).collect()
    check_against_brute_force(rows, list(range(len(texts))), texts)
    asked = jaccard.forest_nodes(jaccard.signatures(docs, 5, plan, [4]), docs.select("doc_id", "text_key", "text"), 5, plan)
    lengths = {r["n"] for r in asked.select(jaccard.length_of("bucket", plan).alias("n")).distinct().collect()}
    assert 4 in lengths and 6 in lengths


@pytest.mark.parametrize("crowd", [0, 200])
def test_links_do_not_depend_on_what_a_crowd_is(spark, documents, monkeypatch, crowd):
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    docs = documents.where("doc_id % 2 = 0").orderBy("doc_id").collect()
    rng = random.Random(4)
    texts = [d["text"] for d in docs] + texts_with_a_common_passage(40, rng)
    texts += [t.replace("p7 ", "q ") for t in texts[-10:]]
    rows = jaccard.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    check_against_brute_force(rows, list(range(len(texts))), texts)


@pytest.mark.parametrize("shape", ["path", "star", "ring", "pairs"])
def test_components(spark, shape):
    n = 40
    links = {
        "path": [(i, i + 1) for i in range(n)],
        "star": [(n, i) for i in range(n)],
        "ring": [(i, (i + 7) % n) for i in range(n)],
        "pairs": [(2 * i, 2 * i + 1) for i in range(n)],
    }[shape]
    random.Random(1).shuffle(links)
    found = groups.components(spark.createDataFrame(links, "a long, b long"), "test").collect()
    label = brute.classes(2 * n + 2, links)
    nodes = {i for pair in links for i in pair}
    assert {r["node"]: r["label"] for r in found} == {i: label[i] for i in nodes}


def test_intersections_of_many_and_two():
    sets = [np.array(sorted(s), np.uint64) for s in ({1, 2, 3}, {2, 3, 4}, {9}, {1, 2, 3, 4, 9})]
    offsets = np.cumsum([0, *map(len, sets)])
    got = jaccard.intersections(np.concatenate(sets), offsets)
    for i in range(4):
        for j in range(4):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))
