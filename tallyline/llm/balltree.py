"""Ranked lexical search: the highest-scoring documents of every query, exactly, by ball trees over sparse vectors.

Score of a document for a query: the sum over the query's distinct terms of ``weight * impact`` (``term_weight``, ``impacts``), all in
64-bit integers. It is an inner product, so documents and queries are vectors over the queries' terms, with the root of the
weight in either factor.

Method. Documents are gathered in trees of up to ``TREE_DOCS``, split in two halves between two far documents until
``LEAF_DOCS`` are left. A node knows its centroid c and the radius of its documents around it, one radius r_g for each group g of terms
(``term_groups``; one radius over all terms alone never pruned anything on the given tables). No document of it can score more for the query
q than ``q.c + sum |q_g| r_g``; the bound is computed in doubles and enlarged by more than all rounding can amount to. A query goes
through the nodes best bound first and stops where the bound is below its k-th best score so far; a node whose bound equals
that score is still opened, as equal scores are ordered by id. At leaves, scores are computed in integers, so results are exact
whatever the bounds do. The best scores so far are carried from one tree of a task to its next.

Scale. Queries come in blocks of at most ``BLOCK_QUERIES`` queries and ``BLOCK_TERMS`` terms (or one query of more terms), so what travels to
tasks and what the driver holds is bounded whatever the number of queries. Each block reads the texts once,
to write the documents' term counts of the block's terms to the shared folder; statistics and trees use those. Texts are never shuffled.
Those counts are small for the work they are, so they, and not the texts, are dealt out evenly before the search.
A task gives k rows per query, which are cut down in two steps, so no query's candidates meet in one task at once.

Defined results: a null text has no terms, and a document without terms is not counted and never ranked. A query without terms, or whose
terms occur nowhere, has no rows. Repeated query rows are ranked each for themselves. Repeated document rows are ranked one after the
other; null ids come after all others of a score. Extra columns are not read. Empty tables give an empty result. Terms are told apart
by 64-bit hashes. Integers hold while 90 * terms of a text * documents stays below 2**63.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyline.llm.tokens import chunks, running, texts_of
from tallyline.session import materialize

TOP = 10
BLOCK_QUERIES = 512
BLOCK_TERMS = 8192
TREE_DOCS = 2048
LEAF_DOCS = 8
CLUSTERS = 8
BANDS = 8
SALTS = 64
#: Most documents of one task, and tasks per core where there are fewer documents.
TASK_DOCS = 1 << 16
TASKS_PER_CORE = 4

# Fixed values of the score: its scale, and the share of a document's length in its damping.
IMPACT_SCALE = 1_000_000_000
TF_SCALE = 1000
DAMPING = 8
LENGTH_SHARE = 90

# A term is a run of ASCII letters and digits and of all characters beyond ASCII.
_BREAK = np.ones(256, bool)
_BREAK[0x30:0x3A] = _BREAK[0x41:0x5B] = _BREAK[0x61:0x7B] = _BREAK[0x80:] = False


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(count: np.ndarray, n_terms: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """Integer impact of a term that occurs ``count`` times among the ``n_terms`` of its document."""
    damping = 100 - LENGTH_SHARE + (LENGTH_SHARE * documents * n_terms) // all_terms
    return (IMPACT_SCALE * count) // (TF_SCALE * count + DAMPING * damping)


@dataclass(frozen=True)
class Block:
    """Queries searched together: ``terms[offsets[i]:offsets[i + 1]]`` are those of query i, as places in ``vocabulary``."""

    ids: list
    vocabulary: np.ndarray
    terms: np.ndarray
    offsets: np.ndarray


def query_blocks(queries: DataFrame, max_queries: int, max_terms: int) -> Iterator[Block]:
    """The queries ``id, text`` in the order of both. The driver holds one block at a time."""

    def block(ids: list, hashes: list[np.ndarray]) -> Block:
        vocabulary = np.unique(np.concatenate(hashes))
        terms = [np.searchsorted(vocabulary, h) for h in hashes]
        return Block(ids, vocabulary, np.concatenate(terms).astype(np.int32), running(np.array([len(t) for t in terms])))

    ids: list = []
    hashes: list[np.ndarray] = []
    for row in queries.orderBy("id", "text").toLocalIterator():
        found = np.unique(texts_of(pa.array([row["text"]], pa.string())).lower_ascii().words(_BREAK).hash)
        if not len(found):
            continue
        if ids and (len(ids) == max_queries or sum(map(len, hashes)) + len(found) > max_terms):
            yield block(ids, hashes)
            ids, hashes = [], []
        ids.append(row["id"])
        hashes.append(found)
    if ids:
        yield block(ids, hashes)


def term_counts(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Per document ``id, text``: ``id, n_terms`` and the vocabulary's terms in it with their counts. A map over whole texts."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "text"):
            words = texts.lower_ascii().words(_BREAK)
            place = np.minimum(np.searchsorted(vocabulary, words.hash), len(vocabulary) - 1)
            known = vocabulary[place] == words.hash
            key, count = np.unique(words.texts()[known] * len(vocabulary) + place[known], return_counts=True)
            ends = pa.array(np.searchsorted(key, np.arange(len(texts) + 1) * len(vocabulary)).astype(np.int32))
            terms = pa.ListArray.from_arrays(ends, pa.array((key % len(vocabulary)).astype(np.int32)))
            counts = pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32)))
            total = pa.array(words.per_text.astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), total, terms, counts], ["id", "n_terms", "terms", "counts"])

    return docs.mapInArrow(run, f"id {kind}, n_terms bigint, terms array<int>, counts array<int>")


@dataclass
class Rows:
    """Sparse vectors laid end to end: row i is ``cols[offsets[i]:offsets[i + 1]]``, none empty."""

    offsets: np.ndarray
    cols: np.ndarray
    impact: np.ndarray

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.offsets[rows + 1] - self.offsets[rows]
        offsets = running(sizes)
        at = np.repeat(self.offsets[rows] - offsets[:-1], sizes) + np.arange(offsets[-1])
        return Rows(offsets, self.cols[at], self.impact[at])

    def dot(self, vector: np.ndarray, root: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.impact * root[self.cols] * vector[self.cols], self.offsets[:-1])


def term_groups(table: np.ndarray) -> np.ndarray:
    """A group below ``CLUSTERS * BANDS`` for each term: queries with like terms, times terms of like weight.

    Queries are clustered by shared terms in a few rounds from far seeds, and a term goes with the cluster that has most of it. Any grouping
    gives right results; a good one keeps what a query does not ask for out of its bounds.
    """
    has = (table > 0).astype(np.float64)
    scaled = has / np.sqrt(np.maximum(has.sum(0), 1))
    like = scaled @ scaled.T
    like /= np.maximum(np.linalg.norm(like, axis=1, keepdims=True), 1e-12)
    seeds = [0]
    while len(seeds) < min(CLUSTERS, len(table)):
        seeds.append(int(np.argmin((like @ like[seeds].T).max(1))))
    means = like[seeds]
    for _ in range(12):
        cluster = (like @ means.T).argmax(1)
        sums = np.zeros_like(means)
        np.add.at(sums, cluster, like)
        means = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    of_cluster = np.zeros((len(means), len(table[0])))
    np.add.at(of_cluster, cluster, has)
    share = of_cluster / np.maximum(np.bincount(cluster, minlength=len(means)), 1)[:, None]
    band = np.argsort(np.argsort(table.max(0), kind="stable")) * BANDS // len(table[0])
    return share.argmax(0) * BANDS + band


@dataclass
class BallTree:
    """Nodes over ``order``: node i holds the documents ``order[low[i]:high[i]]``; its children are ``left[i]`` and the next number, or -1."""

    order: np.ndarray
    low: list[int]
    high: list[int]
    left: list[int]
    centers: np.ndarray
    radii: np.ndarray  # per node and group of terms


def build_tree(rows: Rows, root: np.ndarray, groups: np.ndarray, leaf_docs: int = LEAF_DOCS) -> BallTree:
    """Halve the documents between two far ones until leaves are small; the two are the one furthest from the centroid and the one
    furthest from that."""
    n, kinds = len(rows.offsets) - 1, int(groups.max()) + 1
    order = np.arange(n)
    low, high, left, centers, radii = [0], [n], [-1], [], []
    node = 0
    while node < len(low):
        mine = order[low[node] : high[node]]
        part = rows.take(mine)
        size = len(mine)
        value = part.impact * root[part.cols]
        center = np.bincount(part.cols, value, len(root)) / size
        cell = np.repeat(np.arange(size) * kinds, np.diff(part.offsets)) + groups[part.cols]
        norms = np.bincount(cell, value * value, size * kinds).reshape(size, kinds)
        common = np.bincount(cell, value * center[part.cols], size * kinds).reshape(size, kinds)
        center_norm = np.bincount(groups, center * center, kinds)
        apart = norms - 2 * common + center_norm
        # The difference of large squares is off by far less than this share of them.
        radii.append(np.sqrt(np.maximum(apart.max(0), 0) + 1e-9 * (norms.max(0) + center_norm)))
        centers.append(center)
        if size > leaf_docs:

            def dense(row: int) -> np.ndarray:
                a, b = part.offsets[row], part.offsets[row + 1]
                return np.bincount(part.cols[a:b], value[a:b], len(root))

            one = dense(int(np.argmax(apart.sum(1))))
            to_one = norms.sum(1) - 2 * part.dot(one, root)
            two = dense(int(np.argmax(to_one)))
            side = part.dot(two - one, root)
            middle = size // 2
            order[low[node] : high[node]] = mine[np.argpartition(side, middle)]
            left[node] = len(low)
            low += [low[node], low[node] + middle]
            high += [low[node] + middle, high[node]]
            left += [-1, -1]
        node += 1
    return BallTree(order, low, high, left, np.array(centers), np.array(radii))


class Best:
    """The ``top`` highest scores of a query with their ids; equal scores by ascending id, null ids last."""

    def __init__(self, top: int):
        self.top = top
        self.rows: list[tuple] = []

    @property
    def least(self) -> int:
        """Scores below this one cannot enter any more."""
        return -self.rows[-1][0] if len(self.rows) == self.top else 1

    def offer(self, scores: np.ndarray, ids: list) -> None:
        for k in np.flatnonzero(scores >= self.least):
            key = ids[k]
            self.rows.append((-int(scores[k]), key is None, 0 if key is None else key))
        self.rows = sorted(self.rows)[: self.top]


def search_tree(
    tree: BallTree, rows: Rows, ids: list, table: np.ndarray, vectors: np.ndarray, lengths: np.ndarray, best: list[Best]
) -> tuple[int, int]:
    """Bring ``best`` of each query up to date with the tree's documents. Gives the number of leaves opened and of all leaves.

    ``table`` has the integer weights per query and term, ``vectors`` the query vectors, one per column, and ``lengths`` their lengths within
    each group of terms.
    """
    bounds = (tree.centers @ vectors + tree.radii @ lengths) * (1 + 1e-9) + 1
    ordered = rows.take(tree.order)
    names = [ids[k] for k in tree.order]
    opened = 0
    for query in range(len(best)):
        mine, bound = best[query], bounds[:, query]
        heap = [(-bound[0], 0)]
        while heap:
            limit, node = heapq.heappop(heap)
            if -limit < mine.least:
                break
            if tree.left[node] >= 0:
                for child in (tree.left[node], tree.left[node] + 1):
                    if bound[child] >= mine.least:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            opened += 1
            low, high = tree.low[node], tree.high[node]
            a, b = ordered.offsets[low], ordered.offsets[high]
            parts = table[query, ordered.cols[a:b]] * ordered.impact[a:b]
            mine.offer(np.add.reduceat(parts, ordered.offsets[low:high] - a), names[low:high])
    return opened, len(best) * sum(k < 0 for k in tree.left)


def search_block(counts: DataFrame, block: Block, documents: int, all_terms: int, weights: np.ndarray, top: int) -> DataFrame:
    """The best documents of every query within each task: ``query, id, score``."""
    id_type = counts.schema["id"].dataType
    arrow_type, id_type = to_arrow_type(id_type), id_type.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = np.sqrt(weights.astype(np.float64))
        table = np.zeros((len(block.ids), len(block.vocabulary)), np.int64)
        of = np.repeat(np.arange(len(block.ids)), np.diff(block.offsets))
        table[of, block.terms] = weights[block.terms]
        vectors = np.where(table > 0, root, 0.0).T.copy()
        groups = term_groups(table)
        lengths = np.zeros((int(groups.max()) + 1, len(block.ids)))
        np.add.at(lengths, groups, vectors**2)
        lengths = np.sqrt(lengths)
        best = [Best(top) for _ in block.ids]

        def search(pieces: list[pa.RecordBatch]) -> None:
            held = pa.Table.from_batches(pieces).combine_chunks()
            terms, number = held.column("terms").combine_chunks(), held.column("counts").combine_chunks()
            offsets = np.asarray(terms.offsets, np.int64)
            sizes = np.diff(offsets)
            length = np.repeat(held.column("n_terms").to_numpy(), sizes)
            impact = impacts(number.flatten().to_numpy().astype(np.int64), length, documents, all_terms)
            rows = Rows(offsets - offsets[0], terms.flatten().to_numpy(), impact)
            search_tree(build_tree(rows, root, groups), rows, held.column("id").to_pylist(), table, vectors, lengths, best)

        pieces: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = TREE_DOCS - sum(p.num_rows for p in pieces)
                pieces.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(p.num_rows for p in pieces) == TREE_DOCS:
                    search(pieces)
                    pieces = []
        if pieces:
            search(pieces)
        found = [(query, None if row[1] else row[2], -row[0]) for query, b in enumerate(best) for row in b.rows]
        if found:
            query, names, score = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int32()), pa.array(names, arrow_type), pa.array(score, pa.int64())], ["query", "id", "score"]
            )

    return counts.mapInArrow(run, f"query int, id {id_type}, score bigint")


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    max_queries: int = BLOCK_QUERIES,
    max_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``query_id, rank, id_col, score`` of the ``top`` highest-scoring documents of each query with a score above 0.

    ``rank`` counts from 1; equal scores come in the order of ids.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = queries.select(F.col(query_id).alias("id"), F.col(query_text).cast("string").alias("text"))
    id_kind, query_kind = rows.schema["id"].dataType, asked.schema["id"].dataType
    found = spark.createDataFrame([], f"block int, query int, id {id_kind.simpleString()}, score bigint")
    names = spark.createDataFrame([], f"block int, query int, name {query_kind.simpleString()}")
    for number, block in enumerate(query_blocks(asked, max_queries, max_terms)):
        counts = materialize(term_counts(rows, block.vocabulary), "search-counts")
        totals = counts.agg(
            F.count_if(F.col("n_terms") > 0).alias("documents"), F.sum("n_terms").alias("terms"), F.count_if(F.size("terms") > 0).alias("rows")
        ).first()
        holding = np.zeros(len(block.vocabulary), np.int64)
        for row in counts.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            holding[row["term"]] = row["count"]
        if not holding.any():
            continue
        weights = np.array([term_weight(totals["documents"], int(h)) for h in holding], np.int64)
        fewest = min(totals["rows"] // TREE_DOCS, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
        dealt = counts.where(F.size("terms") > 0).repartition(max(1, fewest, totals["rows"] // TASK_DOCS))
        best = search_block(dealt, block, totals["documents"], totals["terms"], weights, top)
        found = found.union(materialize(best.select(F.lit(number).alias("block"), "query", "id", "score"), "search-best"))
        own = [(number, query, name) for query, name in enumerate(block.ids)]
        names = names.union(spark.createDataFrame(own, names.schema))

    order = [F.desc("score"), F.col("id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for key in (["block", "query", "salt"], ["block", "query"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= top)
    ranked = salted.select("block", "query", F.col("rank").cast("int").alias("rank"), "id", "score")
    return ranked.join(names, ["block", "query"]).select(
        F.col("name").alias(query_id), "rank", F.col("id").alias(id_col), "score"
    )
