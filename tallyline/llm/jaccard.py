"""N-gram Jaccard join: a forest of MinHash prefix tries proposes pairs of texts, and their word n-gram sets are compared exactly.

Method. Every tree gives a text a sequence of MinHash values, and texts with a common prefix share a node of the tree's trie. A prefix
of any length finds a pair at the threshold with the target probability if it is read in enough trees: the shorter, the fewer
(``prefix_trees``). How far a text's prefixes are shortened depends on whom it meets. A text that meets few others at the shortest
length stays there. One in a crowd, as of texts with a passage in common, counts those it meets at each length over the trees of that
length, and takes the length at which they are fewest. All pairs in a node that one of its texts asks for are verified on whole sets.
A pair may meet in several nodes; it belongs to the first of them, longest prefixes first, and is compared there only.

Recall. The share that one length may miss is ``1 - recall`` divided by the number of lengths. A link is missed only if the
length that one of its texts has taken misses it, so whatever the data make of the choice, the sum over all lengths, ``1 - recall``, bounds it.

Scale. Exact copies are one text with a number of copies from the start. Longer prefixes are made for texts in crowds
alone. Nodes that one text alone has are dropped by a count. Of the others, texts without a pair that belongs there and can reach the
threshold by size are left out before any text moves. A crowded node is cut into blocks of at most ``BLOCK`` texts and
``BLOCK_SHINGLES`` n-grams, and each pair of blocks is a group of its own, so no task meets more than two blocks. Pairs never become
rows: a group yields one row per linked text, with its number of links and one link of a spanning forest. Components of the forest are
those of all links.

Defined results: null and empty texts have no n-grams: no links, a class of their own each. A text of fewer words than n
is one n-gram. Repeated rows count as copies. Rows without an id have links but cannot name a class; a class is named by the
smallest id in it. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.groups import components, whole_runs
from tallyline.llm.tokens import CHUNK_BYTES, Texts, mix, running, texts_of, whole_windows, windows
from tallyline.session import materialize

NGRAM = 5
PERCENT = 80
RECALL = 0.9999
LENGTHS = 3
MOST_TREES = 36
CROWD = 200
BLOCK = 1000
BLOCK_SHINGLES = 1 << 20
DENSE_COLUMNS = 4096


def prefix_trees(percent: int, recall: float, lengths: int = LENGTHS, most: int = MOST_TREES) -> dict[int, int]:
    """The lengths of prefixes that are used, longest first, and in how many trees each is to be read.

    Each value of two texts agrees with the probability of their Jaccard similarity. The longest is the one that ``most`` trees suffice for.
    """
    miss = math.log((1 - recall) / lengths)

    def trees(length: int) -> int:
        agree = (percent / 100) ** length
        return 1 if agree == 1 else math.ceil(miss / math.log1p(-agree))

    longest = 1
    while longest < 16 and trees(longest + 1) <= most:
        longest += 1
    return {length: trees(length) for length in range(longest, max(longest - lengths, 0), -1)}


def first_places(plan: dict[int, int]) -> dict[int, int]:
    """Where each length's trees begin in the order in which nodes are visited, longest prefixes first."""
    return {length: sum(t for other, t in plan.items() if other > length) for length in plan}


def length_of(bucket: str, plan: dict[int, int]) -> Column:
    """The length of prefix that a node stands for."""
    place = F.shiftrightunsigned(bucket, 56)
    ends = [(length, first + plan[length]) for length, first in first_places(plan).items()]
    return F.coalesce(*(F.when(place < end, length) for length, end in ends))


def shingles(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word n-grams of each text, ascending, and where each text's begin."""
    words = texts.words()
    ((_, hashes),) = windows(words.hash, [n])
    at = whole_windows(words, n)
    of, value = words.texts()[at], hashes[at]
    short = np.flatnonzero((words.per_text > 0) & (words.per_text < n))
    if len(short):
        shorter = [(np.array([i]), h[:1]) for i in short for _, h in windows(_words_of(words, i), [int(words.per_text[i])])]
        of = np.concatenate([of, *(x[0] for x in shorter)])
        value = np.concatenate([value, *(x[1] for x in shorter)])
    order = np.lexsort((value, of))
    of, value = of[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
    return value[new], np.searchsorted(of[new], np.arange(len(texts) + 1))


def _words_of(words, i: int) -> np.ndarray:
    return words.hash[words.offsets[i] : words.offsets[i + 1]]


def pieces(column: pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a column in order, at most ``limit`` bytes at a time."""
    for chunk in column.chunks:
        texts = texts_of(chunk)
        at = 0
        while at < len(texts):
            to = int(np.searchsorted(texts.offsets, texts.offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), len(texts))
            low, high = texts.offsets[at], texts.offsets[to]
            yield Texts(texts.data[low:high], texts.offsets[at : to + 1] - low)
            at = to


def tree_keys(value: np.ndarray, offsets: np.ndarray, plan: dict[int, int], lengths: list[int]) -> np.ndarray:
    """One key per node on a text's paths, at the given lengths: the node's place in the order of visits, above a hash of the prefix."""
    first = first_places(plan)
    at = running(np.array([plan[length] for length in lengths]))
    keys = np.zeros((len(offsets) - 1, at[-1]), np.uint64)
    filled = np.flatnonzero(np.diff(offsets))
    if not len(filled):
        return keys
    for tree in range(max(plan[length] for length in lengths)):
        read = [length for length in lengths if tree < plan[length]]
        rng = np.random.default_rng([20240229, tree])
        key = np.full(len(filled), tree + 1, np.uint64)
        for level in range(1, max(read) + 1):
            turn, factor = rng.integers(0, 1 << 63, 2, np.uint64)
            least = np.minimum.reduceat((value ^ turn) * (factor * np.uint64(2) + np.uint64(1)), offsets[filled])
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
            if level in read:
                place = np.uint64((first[level] + tree) << 56)
                keys[filled, at[lengths.index(level)] + tree] = key >> np.uint64(8) | place
    return keys


def signatures(docs: DataFrame, n: int, plan: dict[int, int], lengths: list[int]) -> DataFrame:
    """Per document: id, digest of the text, number of distinct n-grams, the keys of its nodes. A map, nothing is shuffled."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    width = sum(plan[length] for length in lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys = [np.zeros(0, np.int64)], [np.zeros((0, width), np.uint64)]
            for texts in pieces(pa.chunked_array([batch.column(2)])):
                value, offsets = shingles(texts, n)
                counts.append(np.diff(offsets))
                keys.append(tree_keys(value, offsets, plan, lengths))
            keys = np.concatenate(keys).view(np.int64).reshape(-1)
            ends = pa.array((np.arange(batch.num_rows + 1) * width).astype(np.int32))
            keys = pa.ListArray.from_arrays(ends, pa.array(keys))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.concatenate(counts)), keys], ["doc_id", "text_key", "n_shingles", "keys"]
            )

    return docs.mapInArrow(run, f"doc_id {kind}, text_key string, n_shingles bigint, keys array<bigint>")


def shared_nodes(texts: DataFrame) -> DataFrame:
    """``bucket, text_key, n_shingles, members, weight``: the texts of every node that has two or more."""
    spread = texts.where("n_shingles > 0").select("text_key", "n_shingles", F.explode("keys").alias("bucket"))
    crowd = spread.groupBy("bucket").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("weight")).where("members > 1")
    return spread.join(crowd, "bucket").select("bucket", "text_key", "n_shingles", "members", "weight")


def chosen_lengths(nodes: DataFrame, plan: dict[int, int]) -> DataFrame:
    """``text_key, length``: the length at which each text meets fewest others over all trees of that length, the shortest of equals."""
    length = length_of("bucket", plan)
    met = [F.coalesce(F.sum(F.when(length == k, F.col("members") - 1)), F.lit(0)).alias(f"met_{k}") for k in sorted(plan)]
    fewest = F.array_min(F.array(*(F.struct(F.col(f"met_{k}").alias("met"), F.lit(k).alias("length")) for k in sorted(plan))))
    return nodes.groupBy("text_key").agg(*met).select("text_key", fewest["length"].alias("length"))


def forest_nodes(texts: DataFrame, rows: DataFrame, n: int, plan: dict[int, int]) -> DataFrame:
    """``bucket, text_key, members, weight``: the nodes that some text asks for, with all their texts.

    ``texts`` has the keys of the shortest length, ``rows`` the texts themselves, of which only those in crowds are read again.
    """
    *longer, shortest = plan
    near = materialize(shared_nodes(texts), "jaccard-nodes")
    met = near.groupBy("text_key").agg(F.sum(F.col("members") - 1).alias("met"))
    crowded = materialize(met.where(F.col("met") > CROWD).select("text_key"), "jaccard-crowded")
    again = rows.join(crowded, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    again = again.select(F.lit(None).cast("bigint").alias("doc_id"), "text_key", "text")
    if longer:
        far = materialize(shared_nodes(signatures(again, n, plan, longer)), "jaccard-nodes")
        chosen = chosen_lengths(near.join(crowded, "text_key", "left_semi").unionByName(far), plan)
        nodes = near.unionByName(far).join(chosen, "text_key", "left")
    else:
        nodes = near.withColumn("length", F.lit(shortest))
    asks = F.coalesce("length", F.lit(shortest)) == length_of("bucket", plan)
    nodes = materialize(nodes.withColumn("asks", asks), "jaccard-nodes")
    asked = nodes.where("asks").select("bucket").distinct()
    return nodes.join(asked, "bucket", "left_semi").select("bucket", "text_key", "members", "weight")


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists, and where each list begins."""
    column = column.combine_chunks()
    return column.flatten().to_numpy(), running(column.value_lengths().to_numpy())


def belonging_pairs(
    keys: np.ndarray, offsets: np.ndarray, blocks: np.ndarray, counts: np.ndarray, bucket: int, one_block: bool, percent: int
) -> np.ndarray:
    """Which pairs of a group's texts belong to it, as an upper triangle: first meeting here, from the blocks that the
    group stands for (one of which may be empty), and near enough in size."""
    size = len(counts)
    pairs = np.triu(np.ones((size, size), bool), 1)
    if not one_block:
        pairs &= blocks[:, None] != blocks[None, :]
    low, high = np.minimum(counts[:, None], counts[None, :]), np.maximum(counts[:, None], counts[None, :])
    pairs &= 100 * low >= percent * high
    keys, of = keys[offsets[0] : offsets[-1]], np.repeat(np.arange(size), np.diff(offsets))
    earlier = keys < bucket
    if pairs.any() and earlier.any():
        visited = running(np.bincount(of[earlier], minlength=size))
        pairs &= intersections(keys[earlier], visited) == 0
    return pairs


def candidate_groups(nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Rows ``bucket, one, two, text_key, block, ...``: the texts of each group that have a pair belonging to it."""
    paths = nodes.groupBy("text_key").agg(F.sort_array(F.collect_list("bucket")).alias("keys"))
    about = texts.select("text_key", "n_shingles", "copies").join(paths, "text_key")
    cuts = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("weight") / BLOCK_SHINGLES)).cast("int")
    members = nodes.select("bucket", "text_key", cuts.alias("cuts"))
    members = members.withColumn("block", F.pmod(F.xxhash64("text_key"), F.col("cuts")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    members = members.select("bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "text_key", "block")
    rows = members.join(about, "text_key")
    rows = rows.select("bucket", "one", "two", "text_key", "block", "n_shingles", "copies", "keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_runs(batches, ["bucket", "one", "two"]):
            (keys, at), counts = _lists(table.column("keys")), table.column("n_shingles").to_numpy()
            blocks, bucket = table.column("block").to_numpy(), table.column("bucket").to_numpy()
            one_block = table.column("one").to_numpy() == table.column("two").to_numpy()
            kept = np.zeros(table.num_rows, bool)
            for low, high in zip(starts[:-1], starts[1:]):
                if high - low > 1:
                    pairs = belonging_pairs(
                        keys, at[low : high + 1], blocks[low:high], counts[low:high], bucket[low], one_block[low], percent
                    )
                    kept[low:high] = pairs.any(0) | pairs.any(1)
            yield from table.filter(pa.array(kept)).combine_chunks().to_batches()

    kinds = "bucket bigint, one int, two int, text_key string, block int, n_shingles bigint, copies bigint, keys array<bigint>"
    return rows.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two").mapInArrow(run, kinds)


def intersections(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many n-grams each two texts share. Only n-grams of two texts or more take part, some columns at a time."""
    size = len(offsets) - 1
    if size == 2:
        both = np.intersect1d(value[: offsets[1]], value[offsets[1] :], assume_unique=True)
        return np.array([[0, len(both)], [len(both), 0]])
    of = np.repeat(np.arange(size), np.diff(offsets))
    _, column, times = np.unique(value, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    of, column = of[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    total = np.zeros((size, size), np.float64)
    width = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, width, DENSE_COLUMNS):
        low, high = np.searchsorted(column, [first, first + DENSE_COLUMNS])
        part = np.zeros((size, min(DENSE_COLUMNS, width - first)), np.float32)
        part[of[low:high], column[low:high] - first] = 1
        total += part @ part.T
    return total.astype(np.int64)


def roots(links: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component, for a symmetric table of links."""
    label = np.arange(len(links))
    while True:
        least = np.where(links, label[None, :], len(links)).min(1)
        after = np.minimum(label, least)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def verified_links(groups: DataFrame, n: int, percent: int) -> DataFrame:
    """Per group and linked text: ``text_key, root, linked_texts, linked_docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_runs(batches, ["bucket", "one", "two"]):
            (keys, at), counts = _lists(table.column("keys")), table.column("n_shingles").to_numpy()
            blocks, bucket = table.column("block").to_numpy(), table.column("bucket").to_numpy()
            one_block = table.column("one").to_numpy() == table.column("two").to_numpy()
            copies, names = table.column("copies").to_numpy(), table.column("text_key").combine_chunks()
            column = table.column("text").combine_chunks()
            rows, root, texts, docs = [], [], [], []
            for low, high in zip(starts[:-1], starts[1:]):
                if high - low < 2:
                    continue
                made = [shingles(piece, n) for piece in pieces(pa.chunked_array([column.slice(low, high - low)]))]
                value = np.concatenate([v for v, _ in made])
                offsets = running(np.concatenate([np.diff(o) for _, o in made]))
                pairs = belonging_pairs(
                    keys, at[low : high + 1], blocks[low:high], counts[low:high], bucket[low], one_block[low], percent
                )
                common = intersections(value, offsets)
                sizes = np.diff(offsets)
                either = sizes[:, None] + sizes[None, :] - common
                links = pairs & (100 * common >= percent * either)
                links |= links.T
                linked = np.flatnonzero(links.any(1))
                if len(linked):
                    links = links[np.ix_(linked, linked)]
                    rows.append(low + linked)
                    root.append(low + linked[roots(links)])
                    texts.append(links.sum(1))
                    docs.append(links @ copies[low + linked])
            if rows:
                rows, root = np.concatenate(rows), np.concatenate(root)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(rows)), names.take(pa.array(root)), pa.array(np.concatenate(texts)), pa.array(np.concatenate(docs))],
                    ["text_key", "root", "linked_texts", "linked_docs"],
                )

    ordered = groups.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")
    return ordered.mapInArrow(run, "text_key string, root string, linked_texts bigint, linked_docs bigint")


def jaccard_join(
    docs: DataFrame,
    n: int = NGRAM,
    percent: int = PERCENT,
    recall: float = RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, text_key, class_key, copy_id, class_id, n_copies, n_linked_texts, n_links``.

    ``class_key`` is the smallest text digest of the class, or null for a text without words, ``copy_id`` the smallest id with the same text, ``class_id`` the smallest id connected by links, ``n_links`` the number of
    other documents at or above the threshold, of which ``n_copies - 1`` have the same text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.md5(text).alias("text_key"), text.alias("text"))
    plan = prefix_trees(percent, recall)
    signed = materialize(signatures(rows, n, plan, [min(plan)]), "jaccard-signatures")
    texts = signed.groupBy("text_key").agg(
        F.min("doc_id").alias("copy_id"),
        F.count("*").alias("copies"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("keys").alias("keys"),
    )
    texts = materialize(texts, "jaccard-texts")
    nodes = materialize(forest_nodes(texts, rows, n, plan), "jaccard-nodes")
    groups = materialize(candidate_groups(nodes, texts, percent), "jaccard-groups")
    once = rows.groupBy("text_key").agg(F.first("text").alias("text"))
    found = materialize(verified_links(groups.join(once, "text_key"), n, percent), "jaccard-links")

    links = found.where("text_key <> root").select(F.col("text_key").alias("a"), F.col("root").alias("b"))
    labels = components(links, "jaccard").select(F.col("node").alias("text_key"), "label")
    per_text = found.groupBy("text_key").agg(F.sum("linked_texts").alias("linked_texts"), F.sum("linked_docs").alias("linked_docs"))
    linked = texts.select("text_key", "copy_id").join(labels, "text_key").join(per_text, "text_key")
    named = linked.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    linked = linked.join(named, "label").select("text_key", "label", "class_id", "linked_texts", "linked_docs")

    every = texts.where("n_shingles > 0").select("text_key", "copy_id", "copies").join(linked, "text_key", "left")
    out = signed.select("doc_id", "text_key").alias("d").join(every.alias("t"), "text_key", "left")
    alone = F.col("copies").isNull()
    return out.select(
        "doc_id",
        "text_key",
        F.when(~alone, F.coalesce("label", "text_key")).alias("class_key"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.coalesce("class_id", "copy_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("linked_texts", F.lit(0)).cast("long").alias("n_linked_texts"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("linked_docs", F.lit(0))).cast("long").alias("n_links"),
    )


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class with all its columns: the one with the smallest id, then the smallest text digest.

    Rows equal in id and text are copies, of which one stays. Texts without words are in no class and all stay, repeated
    rows of one id once.
    """
    joined = jaccard_join(docs, id_col=id_col, text_col=text_col, **options)
    name = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("-"))
    by_class = F.coalesce("class_key", F.concat_ws(" ", "text_key", name))
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("text_key"), name.alias("name"))
    kept = joined.groupBy(by_class.alias("class")).agg(F.min(rank).alias("first")).select("first.name", "first.text_key")
    text_key = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    own = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("-"))
    rows = docs.select(own.alias("name"), text_key.alias("text_key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    once = rows.groupBy("name", "text_key").agg(F.first("row").alias("row"))
    return once.join(kept, ["name", "text_key"], "left_semi").select("row.*")
