"""Language-model scores by deleted interpolation.

The probability of a word after another one is a mixture of three maximum-likelihood estimates: c(v, w) / c(v), c(w) / N and
1 / (V + 1). The weights depend on how often the context v was seen (a bucket per power of two) and are learned by
expectation-maximisation on held-out counts: part of the training texts (``DEV``) is taken out of the counts, and the weights are
those under which the rest explains it best. The final model uses the counts of all training texts.

A text is its words with ASCII letters in lower case, then one end token; its first context is a start token.

Data flow. The corpus is cut into blocks of texts, and tasks turn each into arrays: tokens as numbers into the block's own
vocabulary. A block asks for the corpus counts of its distinct words and word pairs: keys are 64-bit hashes, sorted, cut
into slices by range, packed. All slices of a range meet in one group, which adds up the counts and answers
every block in the order it asked, so answers need no keys. Blocks and their answers are joined once and written.

A block's request is cut into ``FAN`` messages at most. Where the keys need more ranges than that, requests go through
relays: ``FAN`` blocks that ask about the same range are merged to one asker, which asks about ``FAN`` narrower ranges in turn
and passes the answers back. So a message holds a ``FAN``-th of its sender's keys whatever the corpus, and messages grow in
proportion to it, with a factor for the number of stages (two up to 65,536 ranges).

Scale. What moves is one entry per distinct pair of a block, not per occurrence, and no group gets more than about
``GROUP_KEYS`` entries: ranges are as many as the keys need and hashes fill them evenly, so "the" is one entry per block
like any other word. A relay merges as many keys as a block has, on average. The sizes are parameters, to be raised with executor memory.

The EM input is a histogram of all held-out events over (bucket, bigram estimate, unigram estimate), estimates to a quarter
of a power of two. It has a fixed number of possible cells whatever the corpus; only its sums come to the driver.

Defined results: a null text is empty; an empty text is its end token. Rows with a null id are training texts. Repeated rows
count and are scored each. Without training texts all counts are zero. An empty table gives an empty result. Extra
columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tokens import chunks, mix, running
from tallyline.session import drop_shuffles, materialize, materialize_at, remove

TEST, DEV, FOLDS = 1, 0, 5
BLOCK_TOKENS = 1_000_000
GROUP_KEYS = 1_000_000
FAN = 256
BUCKETS = 40
STEPS = 4
CELLS = 200
EM_ROUNDS = 40
FLOOR = 1e-4
END = np.uint64(0x45D9F3B3335B369)
START = np.uint64(0x119DE1F3B8A92C7)


def pack(values: np.ndarray) -> bytes:
    """Non-negative numbers, byte by byte of equal weight, compressed. Small numbers take little room."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T).tobytes(), "zstd", asbytes=True)


def unpack(data: bytes, count: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(data, count * width, "zstd", asbytes=True) if count else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, count).T).reshape(-1).view(kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, count: int) -> np.ndarray:
    return np.cumsum(unpack(data, count, np.uint64), dtype=np.uint64)


BLOCK = "block string, n_docs bigint, n_tokens bigint, n_vocab bigint, lengths binary, fold binary, tokens binary, vocab binary"


def token_blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """The corpus (``doc_id, fold, text``) as blocks, see ``BLOCK``, and the ids of their texts. A map."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def block(ids: list[pa.Array], folds: list[np.ndarray], lengths: list[np.ndarray], hashes: list[np.ndarray]) -> pa.RecordBatch:
        value, tokens, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        length, fold = np.concatenate(lengths), np.concatenate(folds)
        every = pa.concat_arrays(ids)
        columns = [
            pa.array([uuid.uuid4().hex]),
            pa.array([len(length)]),
            pa.array([len(tokens)]),
            pa.array([len(value)]),
            pa.array([pack(length.astype(np.uint32))], pa.binary()),
            pa.array([pack(fold.astype(np.uint8))], pa.binary()),
            pa.array([pack(rank[tokens])], pa.binary()),
            pa.array([pack(value[order])], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in BLOCK.split(", ")] + ["doc_ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch, texts in chunks(batches, "text"):
            words = texts.lower_ascii().words()
            tokens = np.insert(words.hash, words.offsets[1:], END)
            held.append((batch.column(0), batch.column(1).to_numpy(), words.per_text + 1, tokens))
            size += len(tokens)
            if size >= block_tokens:
                yield block(*map(list, zip(*held)))
                held, size = [], 0
        if held:
            yield block(*map(list, zip(*held)))

    return docs.select("doc_id", "fold", "text").mapInArrow(run, f"{BLOCK}, doc_ids array<{kind}>")


class Block:
    """A block's arrays: tokens, contexts (``n_vocab`` for the start), fold of each token, distinct pairs."""

    def __init__(self, row: dict):
        self.n_vocab = row["n_vocab"]
        self.lengths = unpack(row["lengths"], row["n_docs"], np.uint32).astype(np.int64)
        self.doc_fold = unpack(row["fold"], row["n_docs"], np.uint8)
        self.tokens = unpack(row["tokens"], row["n_tokens"], np.uint32).astype(np.int64)
        self.fold = np.repeat(self.doc_fold, self.lengths)
        self.context = np.empty_like(self.tokens)
        self.context[1:] = self.tokens[:-1]
        self.context[running(self.lengths)[:-1]] = self.n_vocab
        if row.get("vocab") is not None:
            self.vocab = unpack(row["vocab"], self.n_vocab, np.uint64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (context, token) pairs as context * n_vocab + token, and the pair of each token."""
        return np.unique(self.context * self.n_vocab + self.tokens, return_inverse=True)

    def pair_keys(self, pairs: np.ndarray) -> np.ndarray:
        words = np.append(self.vocab, START)
        return mix(words[pairs // self.n_vocab] * np.uint64(0x9E3779B97F4A7C15) ^ mix(words[pairs % self.n_vocab]))


def counts_by_fold(of: np.ndarray, fold: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences in all training texts and in those held out for the weights."""
    train = np.bincount(of[fold != TEST], minlength=size)
    return train.astype(np.uint32), np.bincount(of[fold == DEV], minlength=size).astype(np.uint32)


def table_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


SLICE = "slice bigint, block string, n bigint, keys binary, train binary, dev binary"
ANSWER = "block string, kind string, slice bigint, n bigint, train binary, dev binary, known bigint, total bigint, dev_total bigint"


def cut_by_range(asker: str, keys: np.ndarray, train: np.ndarray, dev: np.ndarray, ranges: int) -> pa.Table:
    """One asker's sorted keys with their counts as messages, one per range that has any; see ``SLICE``."""
    part = ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(first[1:], len(keys))
    train, dev = train.astype(np.uint64), dev.astype(np.uint64)
    packed = [(pack_sorted(keys[a:b]), pack(train[a:b]), pack(dev[a:b])) for a, b in zip(first, ends)]
    columns = [
        pa.array(part[first]),
        pa.array([asker] * len(first), pa.string()),
        pa.array(ends - first),
        *(pa.array(column, pa.binary()) for column in (zip(*packed) if packed else ([], [], []))),
    ]
    return pa.table(columns, [c.split()[0] for c in SLICE.split(", ")])


def requests(blocks: DataFrame, kind: str, slices: int) -> DataFrame:
    """Each block's distinct words or pairs with their counts in the block, cut by key range; see ``SLICE``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in table_rows(batches):
            block = Block(row)
            if kind == "word":
                keys, of = block.vocab, block.tokens
            else:
                pairs, of = block.pairs()
                keys = block.pair_keys(pairs)
            train, dev = counts_by_fold(of, block.fold, len(keys))
            order = np.argsort(keys)
            yield from cut_by_range(row["block"], keys[order], train[order], dev[order], slices).to_batches()

    return blocks.select("block", "n_docs", "n_tokens", "n_vocab", "lengths", "fold", "tokens", "vocab").mapInArrow(run, SLICE)


class Merged:
    """Messages about one range: distinct keys in order, their summed counts, and where each message's keys are among them."""

    def __init__(self, rows: list[dict]):
        every = [unpack_sorted(row["keys"], row["n"]) for row in rows]
        self.keys, of = np.unique(np.concatenate(every), return_inverse=True)
        self.places = np.split(of, running(np.array([len(k) for k in every]))[1:-1])
        self.train, self.dev = (
            np.bincount(of, np.concatenate([unpack(row[c], row["n"], np.uint64) for row in rows]), len(self.keys)).astype(np.uint64)
            for c in ("train", "dev")
        )


def answer_table(rows: list[dict], places: list[np.ndarray], kind: str, train: np.ndarray, dev: np.ndarray, totals: tuple[int, int, int]) -> pa.Table:
    """An answer per message, see ``ANSWER``; the totals in the first one."""
    out = [
        (row["block"], kind, row["slice"], row["n"], pack(train[mine]), pack(dev[mine]), *(totals if i == 0 else (0, 0, 0)))
        for i, (row, mine) in enumerate(zip(rows, places))
    ]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [c.split() for c in ANSWER.split(", ")]
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*out), fields)], [n for n, _ in fields])


def answers(asked: DataFrame, kind: str) -> DataFrame:
    """Corpus counts for every slice in the order of its keys; ``known``, ``total`` and ``dev_total`` in one row per range."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        merged = Merged(rows)
        totals = (int((merged.train > 0).sum()), int(merged.train.sum()), int(merged.dev.sum()))
        return answer_table(rows, merged.places, kind, merged.train, merged.dev, totals)

    return asked.groupBy("slice").applyInArrow(run, ANSWER)


def stages_of(slices: int, fan: int) -> tuple[int, int]:
    """The fewest stages that reach so many ranges, and into how many each of them cuts a range."""
    stages = 1
    while fan**stages < slices:
        stages += 1
    factor = 1
    while factor**stages < slices:
        factor += 1
    return stages, factor


def answers_by_relay(asked: DataFrame, kind: str, askers: int, factor: int, stage: int, stages: int) -> DataFrame:
    """``answers`` where requests are cut into ``factor ** stage`` ranges of the ``factor ** stages`` that the keys need."""
    if stage == stages:
        return answers(asked, kind)
    relays = max(1, math.ceil(askers / factor))
    relay = F.concat_ws(":", F.lit(stage), "slice", F.pmod(F.xxhash64("block"), F.lit(relays)))
    asked = materialize(asked.withColumn("relay", relay), f"lm-asked-{stage}")
    ranges = factor ** (stage + 1)

    def forward(table: pa.Table) -> pa.Table:
        merged = Merged(table.to_pylist())
        return cut_by_range(table.column("relay")[0].as_py(), merged.keys, merged.train, merged.dev, ranges)

    def back(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, replies = left.to_pylist(), sorted(right.to_pylist(), key=lambda r: r["slice"])
        train, dev = (np.concatenate([unpack(r[c], r["n"], np.uint64) for r in replies]) for c in ("train", "dev"))
        totals = tuple(sum(r[c] for r in replies) for c in ("known", "total", "dev_total"))
        return answer_table(rows, Merged(rows).places, kind, train, dev, totals)

    told = answers_by_relay(asked.groupBy("relay").applyInArrow(forward, SLICE), kind, relays, factor, stage + 1, stages)
    told = told.withColumnRenamed("block", "relay").groupBy("relay")
    return asked.groupBy("relay").cogroup(told).applyInArrow(back, ANSWER)


COUNTED = "block string, n_docs bigint, n_tokens bigint, n_vocab bigint, lengths binary, fold binary, tokens binary, n_pairs bigint, word_train binary, word_dev binary, pair_train binary, pair_dev binary"


def counted_blocks(blocks: DataFrame, answered: DataFrame) -> DataFrame:
    """Blocks with the corpus counts of their words and pairs in the block's own order; vocabulary no longer needed."""
    ids = blocks.schema["doc_ids"].dataType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.drop_columns(["doc_ids"]).to_pylist()[0]
        block = Block(row)
        pairs, _ = block.pairs()
        replies = sorted(right.to_pylist(), key=lambda r: r["slice"])
        columns = {}
        for kind, keys in (("word", block.vocab), ("pair", block.pair_keys(pairs))):
            order = np.argsort(keys)
            for name in ("train", "dev"):
                told = [unpack(r[name], r["n"], np.uint64) for r in replies if r["kind"] == kind]
                values = np.empty(len(keys), np.uint64)
                values[order] = np.concatenate(told)
                columns[f"{kind}_{name}"] = pack(values)
        kept = left.drop_columns(["vocab"])
        kept = kept.append_column("n_pairs", pa.array([len(pairs)]))
        for name, data in columns.items():
            kept = kept.append_column(name, pa.array([data], pa.binary()))
        return kept.select([*(c.split()[0] for c in COUNTED.split(", ")), "doc_ids"])

    together = blocks.groupBy("block").cogroup(answered.select("block", "kind", "slice", "n", "train", "dev").groupBy("block"))
    return together.applyInArrow(run, f"{COUNTED}, doc_ids {ids}")


class Counts:
    """Per token of a block: counts of the pair, its context and the word in training texts, on request without those held out."""

    def __init__(self, row: dict, without_dev: bool):
        self.block = Block(row)
        pairs, self.pair = self.block.pairs()

        def counts(kind: str, size: int) -> np.ndarray:
            every = unpack(row[f"{kind}_train"], size, np.uint64).astype(np.int64)
            return every - unpack(row[f"{kind}_dev"], size, np.uint64).astype(np.int64) if without_dev else every

        self.words = counts("word", self.block.n_vocab)
        self.pairs = counts("pair", len(pairs))

    def of_tokens(self, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``texts``: training texts, the count of the start as a context."""
        contexts = np.append(self.words, texts)[self.block.context]
        return self.pairs[self.pair], contexts, self.words[self.block.tokens]


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the power of two below its count."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def share(part: np.ndarray, whole: np.ndarray | float) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(part)), where=np.asarray(whole) > 0)


def held_out_histogram(counted: DataFrame, kept_texts: int, kept_tokens: int) -> DataFrame:
    """``cell, n``: held-out events by bucket and estimates; a cell's estimate code 0 stands for 0."""

    def code(estimate: np.ndarray) -> np.ndarray:
        out = np.zeros(len(estimate), np.int64)
        seen = estimate > 0
        out[seen] = np.minimum(np.floor(-STEPS * np.log2(estimate[seen])), CELLS - 2) + 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in table_rows(batches):
            counts = Counts(row, without_dev=True)
            held = counts.block.fold == DEV
            pair, context, word = (x[held] for x in counts.of_tokens(kept_texts))
            cell = bucket_of(context) * CELLS + code(share(pair, context))
            cell, n = np.unique(cell * CELLS + code(share(word, float(kept_tokens))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])

    return counted.drop("doc_ids").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


def learn_weights(cells: np.ndarray, times: np.ndarray, vocabulary: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights of the pair, word and uniform estimates for each bucket, by expectation-maximisation.

    Every weight is at least a third of ``FLOOR``, so that no event is impossible. A bucket without held-out events takes those
    of the bucket below.
    """

    def estimate(code: np.ndarray) -> np.ndarray:
        return np.where(code > 0, 2.0 ** (-(code - 0.5) / STEPS), 0.0)

    bucket = cells // (CELLS * CELLS)
    parts = np.stack([estimate(cells // CELLS % CELLS), estimate(cells % CELLS), np.full(len(cells), 1 / (vocabulary + 1))], 1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    events = np.bincount(bucket, times, BUCKETS)
    for _ in range(rounds):
        shares = weights[bucket] * parts
        shares *= (times / shares.sum(1))[:, None]
        sums = np.stack([np.bincount(bucket, shares[:, k], BUCKETS) for k in range(3)], 1)
        seen = events > 0
        weights[seen] = (1 - FLOOR) * sums[seen] / events[seen, None] + FLOOR / 3
    for empty in np.flatnonzero(events == 0):
        weights[empty] = weights[empty - 1] if empty else np.array([0, 0.5, 0.5])
    return weights


def score_blocks(counted: DataFrame, weights: np.ndarray, texts: int, tokens: int, vocabulary: int) -> DataFrame:
    """One row per text with its scores."""
    ids = counted.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = pa.table(one).drop_columns(["doc_ids"]).to_pylist()[0]
                counts = Counts(row, without_dev=False)
                pair, context, word = counts.of_tokens(texts)
                weight = weights[bucket_of(context)]
                chance = weight[:, 0] * share(pair, context) + weight[:, 1] * share(word, float(tokens)) + weight[:, 2] / (vocabulary + 1)
                base = np.log10((word + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
                lengths = counts.block.lengths
                starts = running(lengths)[:-1]
                columns = [
                    one.column(one.schema.get_field_index("doc_ids")).flatten(),
                    pa.array(counts.block.doc_fold == TEST),
                    pa.array(lengths),
                    pa.array(np.add.reduceat((word > 0).astype(np.int64), starts)),
                    pa.array(np.full(len(lengths), tokens)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(np.log10(chance), starts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    kinds = "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return counted.mapInArrow(run, f"doc_id {ids}, {kinds}")


def score_texts(
    docs: DataFrame,
    block_tokens: int = BLOCK_TOKENS,
    group_keys: int = GROUP_KEYS,
    fan: int = FAN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    Texts whose id has a CRC-32 of 1 modulo 5 are held out from the model; those of 0 are held out from the counts while weights
    are learned.
    """
    fold = F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS, F.lit(FOLDS - 1)).cast("tinyint")
    rows = docs.select(F.col(id_col).alias("doc_id"), fold.alias("fold"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    blocks, blocks_path = materialize_at(token_blocks(rows, block_tokens), "lm-blocks")
    size = blocks.agg(F.count("*").alias("blocks"), F.sum("n_vocab").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    asked = []
    for kind, name in (("word", "words"), ("pair", "tokens")):
        stages, factor = stages_of(max(1, math.ceil((size[name] or 0) / group_keys)), fan)
        asked.append(answers_by_relay(requests(blocks, kind, factor), kind, size["blocks"], factor, 1, stages))
    answered = materialize(asked[0].union(asked[1]), "lm-answers")
    del asked
    drop_shuffles(spark)
    counted = materialize(counted_blocks(blocks, answered), "lm-counted")
    remove(spark, blocks_path)
    drop_shuffles(spark)

    totals = answered.groupBy("kind").agg(F.sum("known").alias("known"), F.sum("total").alias("total"), F.sum("dev_total").alias("dev"))
    of_words = {row["kind"]: row for row in totals.collect()}.get("word")
    vocabulary, tokens, dev_tokens = (of_words["known"], of_words["total"], of_words["dev"]) if of_words else (0, 0, 0)
    texts, dev_texts = 0, 0
    for row in rows.groupBy("fold").count().collect():
        texts += row["count"] * (row["fold"] != TEST)
        dev_texts += row["count"] * (row["fold"] == DEV)
    cells = held_out_histogram(counted, texts - dev_texts, tokens - dev_tokens).collect()
    cells = np.array([(row["cell"], row["n"]) for row in cells], np.int64).reshape(-1, 2)
    weights = learn_weights(cells[:, 0], cells[:, 1].astype(np.float64), vocabulary)
    return score_blocks(counted, weights, texts, tokens, vocabulary)
