"""Periodic runs against a scan of all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyline.llm import queries, runs
from tallyline.llm.tokens import texts_of
from tests.llm.brute import words


def plain_runs(found: list[str], least: int = 12) -> list[tuple[int, int, int]]:
    """``start, length, period`` by start, then period, from the stretches of equal words at every distance."""
    smallest: dict[tuple[int, int], int] = {}
    for q in range(1, len(found) // 2 + 1):
        i = 0
        while i < len(found) - q:
            j = i
            while j < len(found) - q and found[j] == found[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                smallest.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in smallest.items()), key=lambda r: (r[0], r[2]))


def collapsed(found: list[str], of: list[tuple[int, int, int]]) -> str:
    out = {i for s, n, q in of for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(found) if i not in out)


def made(rng: random.Random) -> list[str]:
    letters = "abcdefgh"[: rng.choice([1, 2, 2, 3, 8])]
    out = [rng.choice(letters) for _ in range(rng.choice([0, 1, 11, 12, 13, 60, 150]))]
    if out and rng.random() < 0.6:
        at = rng.randrange(len(out))
        out[at:at] = out[at : at + rng.randint(1, 9)] * rng.randint(1, 7)
    return out


@pytest.mark.parametrize("least", [12, 7, 4])
def test_every_run_is_found_once(least):
    rng = random.Random(least)
    for _ in range(15):
        every = [made(rng) for _ in range(50)]
        found = runs.runs_of(texts_of(pa.array([" ".join(t) for t in every])).words(), least)
        for number, text in enumerate(every):
            assert [tuple(r[1:]) for r in found.tolist() if r[0] == number] == plain_runs(text, least)


def test_whole_rows(spark):
    rng = random.Random(5)
    texts = [" \n ".join(made(rng)) for _ in range(80)] + [None, "", " \t", "é " * 40, "x" * 300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for row in runs.find_runs(docs).collect():
        found = words(texts[row["doc_id"]])
        want = plain_runs(found)
        assert row["n_words"] == len(found)
        assert [tuple(r) for r in row["runs"]] == want
        assert row["collapsed"] == collapsed(found, want)


@pytest.mark.parametrize("text, expected", [("a " * 50_000, 1), ("a b c d e f g " * 9_000, 1)])
def test_one_long_run(text, expected):
    found = runs.runs_of(texts_of(pa.array([text])).words())
    assert len(found) == expected and found[0, 2] == len(text.split())


def test_a_frequent_word_sequence_with_many_left_words():
    """Ten thousand occurrences far apart, every one after another word: no run, and no pair is looked at."""
    text = " ".join(f"left{i} one two three four five six right{i} " + " ".join(f"x{i}y{j}" for j in range(3)) for i in range(10_000))
    assert not len(runs.runs_of(texts_of(pa.array([text])).words()))


def test_odd_documents(spark, odd_documents):
    rows = runs.find_runs(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert runs.find_runs(odd_documents.limit(0)).collect() == []
    assert {r["collapsed"] for r in rows if r["doc_id"] == 3} == {"one two three"}


def test_query_against_plain_version(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, sf_dir).collect()}
    rows = documents.select("doc_id", "text").where(F.length("text") < 6_000).collect()
    planted = 0
    for doc_id, text in rows:
        found, row = words(text), got[doc_id]
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and found:
            n, g = len(found), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            found = [found[i] if i < a else found[a + (i - a) % p] for i in range(n)]
            planted += 1
        want = plain_runs(found)
        assert row["n_runs"] == len(want)
        best = min(want, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if want else None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in want)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(found, want).encode()).hexdigest()
    assert planted > 3 and sum(r["n_runs"] > 0 for r in got.values()) > 3


def test_query_of_odd_rows(spark, tmp_path, odd_documents):
    odd_documents.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == odd_documents.count()
    assert all(re.fullmatch("[0-9a-f]{64}", r["collapsed_sha256"]) and r["runs_sha256"] for r in rows)
    assert {(r["n_runs"], r["start"], r["runs_sha256"]) for r in rows if r["doc_id"] == 1} == {(0, None, empty)}
    assert np.all([r["exponent_milli"] is None for r in rows if r["n_runs"] == 0])
