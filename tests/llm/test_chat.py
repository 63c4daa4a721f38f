from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallyline.llm import chat


def expected(turns):
    said = "".join(text for role, text in turns if role == "assistant")
    every = "".join(f"{role}\n{text}\n" for role, text in turns)
    return (
        len(turns),
        hashlib.sha256(every.encode()).hexdigest(),
        len(said),
        hashlib.sha256(said.encode()).hexdigest(),
        sum(len(chat.format_turn(*turn)[0]) for turn in turns),
    )


def read_back(packs):
    return {
        r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"])
        for r in chat.read_conversations(packs).collect()
    }


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"] or -1, r["turn"] if r["turn"] is not None else -1, r["role"] or "", r["text"] or "")):
        out.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    return {conv: expected(turns) for conv, turns in out.items()}


@given(st.text(alphabet=st.sampled_from(list("<s>/[INST]\\SY\n ab")), max_size=40), st.text(alphabet="ab\n\\<s>", max_size=9))
def test_turns_are_reversible_and_hold_no_control_string(text, role):
    segment, low, high = chat.format_turn(role, text)
    assert chat.parse_turn(segment) == (role, text)
    assert chat.unescape(segment[low:high]) == text
    inner = segment[len(chat.OPEN) : -len(chat.CLOSE)]
    assert not any(mark in inner for mark in chat.CONTROL)


def test_round_trip_of_the_table(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert read_back(chat.format_tree(turns)) == grouped(turns.collect())


def shared_turns(spark):
    rows = []
    for conv in range(60):
        rows += [(conv, 0, "system", "same"), (conv, 1, "user", f"branch {conv % 3}"), (conv, 2, "assistant", f"leaf {conv % 6}")]
        rows += [(conv, 3, "user", "own")] if conv % 2 else []
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("limit", [1 << 20, 100])
def test_shared_turns_are_written_once_in_a_pack(spark, limit):
    packs = chat.format_tree(shared_turns(spark).coalesce(1), pack_chars=limit)
    rows = sorted(packs.collect(), key=lambda r: (r["pack"], r["seq"]))
    assert read_back(packs) == grouped(shared_turns(spark).collect())
    by_pack = {}
    for r in rows:
        by_pack.setdefault(r["pack"], []).append(r)
    for held in by_pack.values():
        turns = {r["seq"]: r for r in held if r["kind"] == "turn"}
        seen = set()
        text = "".join(r["segment"] for r in turns.values())
        for r in turns.values():
            chain, up = [], r["parent"]
            while up is not None:
                chain.insert(0, turns[up])
                up = turns[up]["parent"]
            path = tuple(x["segment"] for x in [*chain, r])
            assert path not in seen  # nothing twice
            seen.add(path)
            above = "".join(x["segment"] for x in chain)
            assert r["position"] == len(above) and r["depth"] == len(chain)
            assert "".join(text[a["start"] : a["end"]] for a in r["attends"]) == above
            assert text[r["start"] : r["end"]] == r["segment"]
        opened = [r["seq"] for r in turns.values() if r["repeated"]]
        assert opened == list(range(len(opened)))  # only at the beginning of a pack
    written = sum(r["kind"] == "turn" and not r["repeated"] for r in rows)
    if limit == 1 << 20:
        assert written - 60 * 0 <= 60 and sum(r["repeated"] for r in rows) == 0


class Unwalked(list):
    """An open path that no turn may walk along."""

    def __iter__(self):
        raise AssertionError("the whole path was walked")


def test_a_turn_costs_no_walk_along_the_path():
    rng, pack, made = random.Random(5), chat.Pack("p"), []
    pack.path = Unwalked()
    for i in range(400):
        depth = rng.randrange(max(0, len(pack.path) - 3), len(pack.path) + 1)
        del pack.path[depth:], made[depth:]
        segment, *body = chat.format_turn("user", "x" * rng.randrange(4))
        pack.put_turn(chat.Turn("user", "x", segment, tuple(body), 0), repeated=False)
        want = []
        for start, end in made:
            if want and want[-1][1] == start:
                want[-1] = (want[-1][0], end)
            else:
                want.append((start, end))
        got = dict(zip([name for name, _, _ in chat.PACKED], pack.rows[-1]))
        assert [(a["start"], a["end"]) for a in got["attends"]] == want
        made.append((got["start"], got["end"]))


def test_rows_of_a_pack_are_written_and_read_in_pieces(spark, monkeypatch):
    turns = shared_turns(spark)
    whole = sorted(chat.format_tree(turns.coalesce(1)).collect())
    monkeypatch.setattr(chat, "HELD_ROWS", 3)
    assert sorted(chat.format_tree(turns.coalesce(1)).collect()) == whole


def test_a_conversation_of_very_many_turns(spark):
    turns = spark.range(60_000).selectExpr(
        "CAST(NULL AS LONG) AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text"
    )
    assert read_back(chat.format_tree(turns)) == grouped(turns.collect())


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", None, "x"), (1, 0, "a\nb", "x\\</s>", "x"), (1, 0, "a\nb", "x\\</s>", "x"), (1, None, None, "", None),
        (2, 0, "assistant", "", "y"), (3, 5, "assistant", "w " * 100_000, "y"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string")
    assert read_back(chat.format_tree(turns)) == grouped(turns.collect())
    assert chat.read_conversations(chat.format_tree(turns.limit(0))).count() == 0
