"""Ranked search against a plain scorer; that bounds hold and prune; blocks of queries; odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tallyline.llm import balltree
from tallyline.llm.oracle import search_sql


def terms(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs: list[tuple], items: list[tuple], top: int = 10) -> list[tuple]:
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    bags = [(d, bag) for d, bag in bags if bag]
    n, words = len(bags), sum(sum(bag.values()) for _, bag in bags)
    holding = Counter(t for _, bag in bags for t in bag)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n) // words
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in set(terms(text))
                if bag[t]
            )
            if score:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item_id, rank, None if missing else doc_id, -score))
    return out


def sorted_rows(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)


def texts(rng: random.Random, n: int) -> list[str]:
    names = [f"w{i}" for i in range(200)] + ["É", "ü2", "Zed"]
    return [" ".join(rng.choice(names[: rng.choice([20, 100, 203])]) for _ in range(rng.choice([0, 3, 30, 90]))) for _ in range(n)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    docs = [(i // 2, t) for i, t in enumerate(texts(rng, 700))]  # every id twice
    docs += [(None, docs[3][1]), (None, None), (900, docs[3][1]), (901, docs[3][1]), (902, "W1, w1;W1 É"), (903, "w1 " * 50_000)]
    items = [(i, t) for i, t in enumerate(texts(rng, 25))]
    items += [(3, "w1 w2"), (None, "w5 É"), (99, ""), (98, None), (97, "nowhere"), (96, docs[3][1])]
    return docs, items


def frames(spark, tables):
    docs, items = tables
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.mark.parametrize("options", [{}, {"max_queries": 4}, {"max_terms": 30}, {"top": 3}])
def test_rows_of_the_plain_scorer(spark, tables, options, monkeypatch):
    monkeypatch.setattr(balltree, "TREE_DOCS", 150)
    got = balltree.ranked_search(*frames(spark, tables), **options).collect()
    assert sorted_rows(got) == sorted_rows(plain(*tables, top=options.get("top", 10)))


def test_sql_gives_the_same(spark, tables):
    docs, items = tables
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE i (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?)", docs)
    con.executemany("INSERT INTO i VALUES (?, ?)", items)
    found = con.execute(f"WITH {search_sql('d', 'i')} SELECT item_id, rank, doc_id, score FROM ranked").fetchall()
    assert sorted_rows(found) == sorted_rows(plain(docs, items))


def sparse(rng, groups: int, per_group: int, terms: int):
    """Documents of which those of a group share most terms."""
    rows = []
    for _ in range(groups):
        common = rng.choice(terms, 12, replace=False)
        for _ in range(per_group):
            own = np.unique(np.concatenate([common, rng.choice(terms, 3, replace=False)]))
            rows.append((own.astype(np.int32), rng.integers(100, 1000, len(own)) * 100))
    offsets = np.concatenate([[0], np.cumsum([len(c) for c, _ in rows])])
    return balltree.Rows(offsets, np.concatenate([c for c, _ in rows]), np.concatenate([v for _, v in rows]))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    rows = sparse(rng, 40, 50, 2_000)
    weights = rng.integers(1, 9_000, 2_000)
    table = np.zeros((30, 2_000), np.int64)
    for query in table:
        picked = rng.integers(len(rows.offsets) - 1)
        own = rows.cols[rows.offsets[picked] : rows.offsets[picked + 1]]
        query[own] = weights[own]
    root = np.sqrt(weights.astype(float))
    vectors = np.where(table > 0, root, 0.0).T
    groups = balltree.term_groups(table)
    lengths = np.zeros((groups.max() + 1, 30))
    np.add.at(lengths, groups, vectors**2)
    lengths = np.sqrt(lengths)
    tree = balltree.build_tree(rows, root, groups)
    assert sorted(tree.order.tolist()) == list(range(2_000))

    dense = np.zeros((2_000, 2_000), np.int64)
    dense[np.repeat(np.arange(2_000), np.diff(rows.offsets)), rows.cols] = rows.impact
    scores = dense @ table.T
    bounds = (tree.centers @ vectors + tree.radii @ lengths) * (1 + 1e-9) + 1
    for node, (low, high) in enumerate(zip(tree.low, tree.high)):
        assert (scores[tree.order[low:high]].max(0) <= bounds[node]).all()

    best = [balltree.Best(10) for _ in range(30)]
    opened, leaves = balltree.search_tree(tree, rows, list(range(2_000)), table, vectors, lengths, best)
    for query, found in enumerate(best):
        order = sorted((-int(s), False, d) for d, s in enumerate(scores[:, query]) if s)[:10]
        assert found.rows == order
    assert opened < leaves / 4


def test_documents_all_alike(spark):
    docs = spark.createDataFrame([(i, "same few words") for i in range(300)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "few other words")], "item_id long, text string")
    rows = balltree.ranked_search(docs, items).orderBy("rank").collect()
    assert [r["doc_id"] for r in rows] == list(range(10))


def test_empty_tables_and_odd_columns(spark, odd_documents):
    items = odd_documents.selectExpr("doc_id AS item_id", "text", "lang AS rank", "source AS score", "key AS doc_id")
    none = balltree.ranked_search(odd_documents.limit(0), items)
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.collect() == []
    assert balltree.ranked_search(odd_documents, items.limit(0)).collect() == []
    docs = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    got = balltree.ranked_search(odd_documents, items).collect()
    assert sorted_rows(got) == sorted_rows(plain(docs, docs))
