"""Chat formatting as a prefix tree: shared initial turns are written once.

Every turn becomes a segment ``<s>role\\ntext</s>``. Control strings inside roles and texts get a backslash after their first
character and backslashes are doubled, so that no control string is left in them and ``unescape`` gives the original.

Conversations are ordered by the chained digests of their turns, which puts those with common initial turns next to each
other, in depth-first order of their prefix tree. One pass writes each new turn once. A turn has its place in the
pack (``start``, ``end``), the position of its first character in its conversation (``position``; later ones count on),
the intervals of the pack that its ancestors take, to which it attends besides itself, and the interval of the loss
mask. An ``end`` row closes a conversation at its last turn. Places are in characters (code points).

Packs. A pack ends after the conversation that brings it to ``PACK_CHARS``; a task begins a pack of its own. A pack is
self-contained, as a model sees nothing else: if a tree goes on in the next pack, the turns open at that point are written
there once more, with ``repeated`` set. Within a pack nothing is written twice.

Scale. One shuffle gathers conversations, one orders them. Conversations that share all turns are ordered by id, so a first turn or a
whole conversation that a third of all rows have is dealt over many tasks. Work is in proportion to the turns: the intervals of
the open path are kept, not made anew for each turn, and packs are written and read a few rows at a time. A conversation is still
one value when it is gathered and ordered, so all its turns have to fit a task.

Defined results: null roles and texts are empty; a null conversation id is a conversation of its own. Turns are ordered by
turn, null first, then role, then text, and repeated turns are turns. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
CONTROL = (OPEN, CLOSE, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ASSISTANT = "assistant"
PACK_CHARS = 1 << 20
HELD_ROWS, HELD_CHARS = 1 << 13, 1 << 20

_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_SEGMENT = re.compile(r"<s>((?:[^\\\n]|\\.)*)\n(.*)</s>", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)

INTERVALS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
PACKED = [
    ("pack", "string", pa.string()),
    ("seq", "bigint", pa.int64()),
    ("kind", "string", pa.string()),
    ("conv_id", "bigint", pa.int64()),
    ("depth", "int", pa.int32()),
    ("parent", "bigint", pa.int64()),
    ("segment", "string", pa.string()),
    ("repeated", "boolean", pa.bool_()),
    ("start", "bigint", pa.int64()),
    ("end", "bigint", pa.int64()),
    ("position", "bigint", pa.int64()),
    ("attends", "array<struct<start:bigint,end:bigint>>", INTERVALS),
    ("loss_start", "bigint", pa.int64()),
    ("loss_end", "bigint", pa.int64()),
]
READ = [
    ("conv_id", "bigint", pa.int64()),
    ("n_turns", "bigint", pa.int64()),
    ("turns_sha256", "string", pa.string()),
    ("loss_chars", "bigint", pa.int64()),
    ("loss_sha256", "string", pa.string()),
    ("formatted_chars", "bigint", pa.int64()),
]


def ddl(columns: list[tuple]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind, _ in columns)


def record_batch(rows: list[tuple], columns: list[tuple]) -> pa.RecordBatch:
    values = list(zip(*rows)) or [[] for _ in columns]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, (_, _, k) in zip(values, columns)], [n for n, _, _ in columns])


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The segment of a turn and the part of it that is the text."""
    head = OPEN + escape(role).replace("\n", "\\\n") + "\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse_turn(segment: str) -> tuple[str, str]:
    found = _SEGMENT.fullmatch(segment)
    if not found:
        raise ValueError(f"not a turn: {segment[:80]!r}")
    return unescape(found[1]), unescape(found[2])


def turn_path(roles: list[str], texts: list[str]) -> bytes:
    """Eight bytes per turn that depend on it and all turns before."""
    digest, parts = hashlib.sha256(), []
    for role, text in zip(roles, texts):
        digest.update(f"{len(role)}:{role}{len(text)}:{text}".encode())
        parts.append(digest.digest()[:8])
    return b"".join(parts)


def gather(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, roles, texts, path``."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = F.sort_array(F.collect_list(turn))
    rows = conversations.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", "turns.role", "turns.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [turn_path(r.as_py(), t.as_py()) for r, t in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, pa.binary())], ["conv_id", "roles", "texts", "path"])

    return rows.mapInArrow(run, "conv_id bigint, roles array<string>, texts array<string>, path binary")


@dataclass
class Turn:
    role: str
    text: str
    segment: str
    body: tuple[int, int]
    position: int
    seq: int = -1
    start: int = -1
    spans: int = 0  # how many intervals the open path takes down to this turn

    @property
    def end(self) -> int:
        return self.start + len(self.segment)


@dataclass
class Pack:
    """Rows of one pack that are not written yet, the open path of its tree and the intervals that path takes."""

    name: str
    rows: list[tuple] = field(default_factory=list)
    seq: int = 0
    size: int = 0
    path: list[Turn] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    held: int = 0

    def put_turn(self, turn: Turn, repeated: bool) -> None:
        above = self.path[-1] if self.path else None
        del self.spans[above.spans if above else 0 :]
        if above:  # a turn that the path has left may have made the last interval longer
            self.spans[-1] = (self.spans[-1][0], above.end)
        turn.seq, turn.start = self.seq, self.size
        loss = (turn.start + turn.body[0], turn.start + turn.body[1]) if turn.role == ASSISTANT else (None, None)
        end = turn.end
        parent = above.seq if above else None
        seen = [{"start": a, "end": b} for a, b in self.spans]
        self.rows.append(
            (self.name, turn.seq, "turn", None, len(self.path), parent, turn.segment, repeated, turn.start, end, turn.position, seen, *loss)
        )
        if self.spans and self.spans[-1][1] == turn.start:
            self.spans[-1] = (self.spans[-1][0], end)
        else:
            self.spans.append((turn.start, end))
        turn.spans = len(self.spans)
        self.path.append(turn)
        self.seq += 1
        self.size = end
        self.held += len(turn.segment) + len(seen)

    def put_end(self, conv_id: int | None) -> None:
        parent = self.path[-1].seq if self.path else None
        self.rows.append((self.name, self.seq, "end", conv_id, len(self.path), parent, None, False, None, None, None, None, None, None))
        self.seq += 1

    def full(self) -> bool:
        return len(self.rows) >= HELD_ROWS or self.held >= HELD_CHARS

    def written(self) -> pa.RecordBatch:
        """The rows so far, which are not held any longer."""
        rows, self.rows, self.held = self.rows, [], 0
        return record_batch(rows, PACKED)


def format_tree(conversations: DataFrame, pack_chars: int = PACK_CHARS) -> DataFrame:
    """The packs of all conversations (``conv_id, turn, role, text``), rows as in ``PACKED``."""
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    ordered = gather(rows).repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = None
        for batch in batches:
            for conv_id, roles, texts, path in zip(*(column.to_pylist() for column in batch.columns)):
                before = pack.path if pack else []
                shared = 0
                while shared < min(len(before), len(roles)) and (before[shared].role, before[shared].text) == (roles[shared], texts[shared]):
                    shared += 1
                if pack is None or pack.size >= pack_chars:
                    if pack:
                        yield pack.written()
                    pack = Pack(hashlib.sha256(path + str(conv_id).encode()).hexdigest()[:32])
                    for turn in before[:shared]:
                        pack.put_turn(turn, repeated=True)
                        if pack.full():
                            yield pack.written()
                del pack.path[shared:]
                for role, text in zip(roles[shared:], texts[shared:]):
                    segment, *body = format_turn(role, text)
                    above = pack.path[-1] if pack.path else None
                    position = above.position + len(above.segment) if above else 0
                    pack.put_turn(Turn(role, text, segment, tuple(body), position), repeated=False)
                    if pack.full():
                        yield pack.written()
                pack.put_end(conv_id)
        if pack:
            yield pack.written()

    return ordered.mapInArrow(run, ddl(PACKED))


@dataclass
class Seen:
    """What has been read of a conversation down to one turn."""

    turns: object
    loss: object
    loss_chars: int
    chars: int


def read_conversations(packs: DataFrame) -> DataFrame:
    """Each conversation's digests, read from segments and loss intervals along its path; rows as in ``READ``."""
    columns = ["pack", "seq", "kind", "conv_id", "depth", "segment", "start", "loss_start", "loss_end"]
    rows = packs.select(*columns).repartition("pack").sortWithinPartitions("pack", "seq")
    held = [columns.index(name) for name in columns if name != "seq"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, path = None, []
        for batch in batches:
            out = []
            for name, kind, conv_id, depth, segment, start, loss_start, loss_end in zip(*(batch.column(c).to_pylist() for c in held)):
                if name != pack or not path:
                    pack, path = name, [Seen(hashlib.sha256(), hashlib.sha256(), 0, 0)]
                del path[depth + 1 :]
                last = path[-1]
                if kind == "end":
                    out.append((conv_id, depth, last.turns.hexdigest(), last.loss_chars, last.loss.hexdigest(), last.chars))
                    continue
                role, text = parse_turn(segment)
                turns, loss = last.turns.copy(), last.loss.copy()
                turns.update(f"{role}\n{text}\n".encode())
                masked = "" if loss_start is None else unescape(segment[loss_start - start : loss_end - start])
                loss.update(masked.encode())
                path.append(Seen(turns, loss, last.loss_chars + len(masked), last.chars + len(segment)))
            yield record_batch(out, READ)

    return rows.mapInArrow(run, ddl(READ))
