from __future__ import annotations

from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.operators import overlap

SETS = "set_key STRING, member STRING"


def sets(spark, users: dict[str, set]):
    rows = [(f"set_var_{v}", str(u)) for v, members in users.items() for u in members]
    return spark.createDataFrame(rows, SETS)


def brute(users: dict[str, set]) -> dict:
    return {(a, b): float(len(users[a] & users[b])) for a, b in combinations(sorted(users), 2)}


def as_dict(frame):
    return {(r["dim_a"], r["dim_b"]): r["metric"] for r in frame.collect()}


CASES = {
    "none": {},
    "one": {"1": {1, 2}},
    "disjoint": {"1": {1}, "2": {2}},
    "three": {"default": {1, 2, 3}, "1": {2, 3}, "2": {3, 4}},
}


@pytest.mark.parametrize("name", CASES)
def test_overlap(spark, name):
    frame = sets(spark, CASES[name])
    assert as_dict(overlap.variant_overlap(frame)) == brute(CASES[name])


def test_repeated_rows_and_unknown_users(spark):
    events = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, "a"), (None, "b"), (3, None)], "uid BIGINT, variant STRING"
    )
    assert as_dict(overlap.variant_overlap(overlap.memberships(events))) == {("a", "b"): 1.0}
    assert overlap.variant_users(events).count() == 3


def test_prefix_is_literal(spark):
    frame = sets(spark, CASES["disjoint"]).unionByName(
        spark.createDataFrame([("setXvar_9", "1"), ("set_var", "1"), ("my_set_var_8", "1")], SETS)
    )
    assert sorted(r[0] for r in overlap.discover_variants(frame).collect()) == ["1", "2"]
    assert as_dict(overlap.variant_overlap(frame)) == {("1", "2"): 0.0}


def test_only_the_first_prefix_is_stripped(spark):
    frame = spark.createDataFrame([("set_var_set_var_x", "1")], SETS)
    assert overlap.discover_variants(frame).first()[0] == "set_var_x"


def test_members_and_intersect(spark, tmp_path):
    frame = sets(spark, CASES["three"])
    path = str(tmp_path / "overlap")
    for _ in range(2):  # a second run replaces the first
        overlap.store_overlap(overlap.overlap_members(frame), path)
    stored = spark.read.schema("member STRING, overlap_key STRING").parquet(path)
    assert {(r["overlap_key"], r["member"]) for r in stored.collect()} == {
        ("overlap_-set_var_1-set_var_2", "3"),
        ("overlap_-set_var_1-set_var_default", "2"),
        ("overlap_-set_var_1-set_var_default", "3"),
        ("overlap_-set_var_2-set_var_default", "3"),
    }
    assert stored.count() == 4
    assert {r[0] for r in overlap.intersect(frame, "1", "default").collect()} == {"2", "3"}


def test_matrix_and_dimensions(spark):
    frame = sets(spark, CASES["three"])
    pairs = overlap.variant_overlap(frame)
    matrix = overlap.overlap_matrix(pairs, ["default", "1", "2"])
    assert matrix.columns == ["variant", "1", "2", "default"]
    assert sorted(map(tuple, matrix.collect())) == [("1", None, 1.0, 2.0), ("2", None, None, 1.0)]
    assert {r[0] for r in overlap.overlap_dimensions(pairs).collect()} == {"1", "2", "default"}
    points = {(tuple(r["dimensions"]), r["metric"]) for r in overlap.with_dimensions(pairs).collect()}
    assert points == {(("1", "2"), 1.0), (("1", "default"), 2.0), (("2", "default"), 1.0)}


def test_a_member_of_very_many_variants(spark):
    """Its pairs are cut into slices; none is lost or counted twice."""
    users = {f"v{i:04d}": {0} | ({i % 7 + 1} if i < 100 else set()) for i in range(2000)}
    found = overlap.variant_overlap(sets(spark, users))
    assert found.count() == 2000 * 1999 // 2
    totals = found.agg(F.sum("metric")).first()[0]
    assert totals == 2000 * 1999 / 2 + sum(n * (n - 1) / 2 for n in (15, 15, 14, 14, 14, 14, 14))


def test_one_scan_of_the_sets(spark, sf_dir):
    frame = overlap.variant_overlap(overlap.memberships(
        spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderpriority AS variant", "o_custkey AS uid")
    ))
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    final = text.split("Initial Plan")[0]
    assert final.count("ReusedExchange") + final.count("ReusedQueryStage") >= 1 or final.count("FileScan") == 1


def test_all_pairs_once(spark):
    names = [f"v{i:02d}" for i in range(40)]
    variants = spark.createDataFrame([(n,) for n in names], "variant STRING")
    found = [tuple(r) for r in overlap.variant_pairs(variants).collect()]
    assert len(found) == len(set(found)) == 780
    assert set(found) == set(combinations(names, 2))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.text("abc_-|", min_size=1, max_size=4), st.sets(st.integers(0, 12), min_size=1), max_size=6))
def test_overlap_matches_brute_force(spark, users):
    assert as_dict(overlap.variant_overlap(sets(spark, users))) == brute(users)


def test_conversion(spark):
    events = spark.createDataFrame(
        [(1, 1, "view"), (1, 1, "purchase"), (1, 2, "view"), (2, 1, "view")], "experiment_id INT, uid BIGINT, variant STRING"
    )
    found = sorted(map(tuple, overlap.experiment_conversion(events, "purchase").collect()))
    assert found == [(1, 2, 1, 0.5), (2, 1, 0, 0.0)]


def test_conversion_without_users(spark):
    """Events without a user are nobody's, as in SQL's count(DISTINCT uid)."""
    events = spark.createDataFrame(
        [(1, 1, "purchase"), (1, None, "purchase"), (1, None, "view"), (1, 2, None), (2, None, "purchase"), (None, 5, "view")],
        "experiment_id INT, uid BIGINT, variant STRING",
    )
    found = {r[0]: tuple(r[1:]) for r in overlap.experiment_conversion(events, "purchase").collect()}
    assert found == {1: (2, 1, 0.5), 2: (0, 0, None), None: (1, 0, 0.0)}
