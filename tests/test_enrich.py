from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyline.operators.counters import count_by_key, merge_counters, stock_movement
from tallyline.operators.enrich import branch_misses, enrich, enrich_as_of, enrich_from_snapshot, lookup_misses, snapshot_as_of
from tallyline.operators.route import by_company, route, split
from tallyline.sources.lookup import Lookup, store_bucketed

MOVEMENT = "branch STRING, company STRING, sku STRING, value STRING"
LOOKUP = "branch STRING, company STRING"
LIMITS = {"replicated": 1 << 20, "shuffled": 0}


@pytest.fixture(params=LIMITS, ids=list(LIMITS))
def limit(request):
    return LIMITS[request.param]


def lookup(spark, rows, limit=1 << 20):
    return Lookup.measure(spark.createDataFrame(rows, LOOKUP), broadcast_limit=limit)


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def plan(frame):
    return frame._jdf.queryExecution().toString()


def test_enrich(spark, limit):
    moves = spark.createDataFrame(
        [("b1", "", "s", "1"), ("b2", "", "s", "2"), ("b9", "", "s", "3"), ("b1", "7", "s", "4")], MOVEMENT
    )
    branches = lookup(spark, [("b1", "1"), ("b2", "2")], limit)
    assert rows(enrich(moves, branches)) == [("b1", "1", "s", "1"), ("b2", "2", "s", "2")]
    assert ("b1", "7", "s", "4") in rows(enrich(moves, branches, keep_assigned=True))
    assert rows(lookup_misses(moves, branches)) == [("b9", "s", "3")]


def test_a_hot_branch_is_spread(spark, tmp_path):
    """One branch has a third of the rows; the skew join parts them by the tasks they come from."""
    moves = spark.range(0, 60_000, 1, 24).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS branch", "'' AS company", "MD5(CAST(id AS STRING)) AS sku", "'1' AS value"
    )
    moves.selectExpr("branch", "'1' AS company").distinct().write.parquet(f"{tmp_path}/branches")
    branches = Lookup.measure(spark.read.parquet(f"{tmp_path}/branches"), broadcast_limit=0)
    small = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        dealt = enrich(moves, branches).select("branch", "sku", F.spark_partition_id().alias("p")).collect()
        assert len(dealt) == 60_000
        hot = Counter(r["p"] for r in dealt if r["branch"] == "hot")
        assert len(hot) > 4 and max(hot.values()) < 10_000
        assert stock_movement(moves, branches).agg(F.sum("total")).first()[0] == 60_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_where_a_row_goes_depends_on_its_key_alone(spark):
    """The order in which a task meets its rows, which changes when a lost one is run again, changes no row's partition."""
    moves = spark.range(3_000).selectExpr("CAST(id % 40 AS STRING) AS branch", "'' AS company", "CAST(id AS STRING) AS sku", "'1' AS value")
    branches = Lookup.measure(moves.selectExpr("branch", "'1' AS company").distinct(), broadcast_limit=0)

    def places(frame):
        return {r["sku"]: r["p"] for r in enrich(frame, branches).select("sku", F.spark_partition_id().alias("p")).collect()}

    assert places(moves.repartition(4, "sku")) == places(moves.orderBy(F.desc("sku")).repartition(4))


def test_messages_are_parsed_once_for_a_shuffled_join(spark):
    from tallyline.operators.parse import accepted, parse_cdc

    messages = spark.createDataFrame([("{}",)], "value STRING")
    text = plan(enrich(accepted(parse_cdc(messages)), lookup(spark, [("b1", "1")], 0)))
    physical = text[text.index("== Physical Plan") :]
    assert physical.count("from_json") == 1


def test_bucketed_lookup_is_not_shuffled(spark):
    moves = spark.range(500).selectExpr("CAST(id % 50 AS STRING) AS branch", "'' AS company", "CAST(id AS STRING) AS sku", "'1' AS value")
    small = lookup(spark, [(str(i), str(i % 3)) for i in range(40)], 0)
    stored = store_bucketed(small, "test_bucketed_branches")
    assert rows(enrich(moves, stored)) == rows(enrich(moves, small))
    text = plan(enrich(moves, stored))
    physical = text[text.index("== Physical Plan") :]
    assert "SortMergeJoin" in physical and physical.count("Exchange hashpartitioning") == 1
    assert plan(enrich(moves, small)).split("== Physical Plan")[1].count("Exchange hashpartitioning") == 2
    spark.sql("DROP TABLE test_bucketed_branches")


def test_large_lookup_is_joined_through_a_shuffle(spark):
    moves = spark.createDataFrame([("b1", "", "s", "1")], MOVEMENT)
    text = plan(enrich(moves, lookup(spark, [("b1", "1")], 0)))
    assert "SortMergeJoin" in text


def test_misses_are_counted_before_the_join(spark, limit):
    moves = spark.createDataFrame([("b9", "", str(i), "1") for i in range(5)] + [("b1", "", "s", "1"), ("b8", "2", "s", "1")], MOVEMENT)
    assert [tuple(r) for r in branch_misses(moves, lookup(spark, [("b1", "1")], limit)).collect()] == [("b9", 5)]


def test_small_lookup_is_replicated(spark):
    moves = spark.createDataFrame([("b1", "", "s", "1")], MOVEMENT)
    assert "BroadcastHashJoin" in plan(enrich(moves, lookup(spark, [("b1", "1")])))


def test_routes(spark):
    moves = spark.createDataFrame([("b", c, "s", "1") for c in ["1", "2", "", None]], MOVEMENT)
    chosen, rest = split(moves, by_company("1"), 2)
    assert [r["company"] for r in chosen.collect()] == ["1"]
    assert rest.count() == 3
    with pytest.raises(Exception, match="route outside 0..1: 2"):
        route(moves, F.lit(2), 2).collect()
    with pytest.raises(Exception, match="route outside 0..1: null"):
        route(moves, F.lit(None).cast("int"), 2).collect()


def test_counters(spark, limit):
    moves = spark.createDataFrame(
        [("b1", "", "s", "5"), ("b1", "", "s", "-7"), ("b1", "", "t", "0"), ("b2", "", "s", "9")], MOVEMENT
    )
    branches = lookup(spark, [("b1", "1"), ("b2", "2")], limit)
    assert rows(stock_movement(moves, branches)) == [("b1|1|s", -2), ("b1|1|t", 0)]
    assert rows(stock_movement(moves, branches, company="2")) == [("b2|2|s", 9)]
    assert rows(stock_movement(moves, branches, company="3")) == []


def test_equal_keys_share_a_counter(spark, limit):
    """The key is text, so fields with the separator in them may meet."""
    moves = spark.createDataFrame([("a|1|b", "", "c", "1"), ("a", "", "b|1|c", "2")], MOVEMENT)
    branches = lookup(spark, [("a|1|b", "1"), ("a", "1")], limit)
    assert rows(stock_movement(moves, branches)) == [("a|1|b|1|c", 3)]


def test_overflow_of_a_wanted_counter_is_an_error(spark, limit):
    most = str(2**63 - 1)
    moves = spark.createDataFrame([("b1", "", "s", most)] * 2 + [("b2", "", "s", "1")], MOVEMENT)
    branches = lookup(spark, [("b1", "1"), ("b2", "2")], limit)
    assert rows(stock_movement(moves, branches, company="2")) == [("b2|2|s", 1)]
    with pytest.raises(Exception, match="overflow|OVERFLOW"):
        stock_movement(moves, branches).collect()


def test_partials_fold_in_any_order(spark):
    moves = spark.range(1000).selectExpr(
        "CAST(id % 7 AS STRING) AS branch", "'1' AS company", "CAST(id % 3 AS STRING) AS sku",
        "CAST(id - 500 AS STRING) AS value", "id % 5 AS batch_id",
    )
    parts = count_by_key(moves, "batch_id").drop("batch_id")
    assert rows(merge_counters(parts)) == rows(count_by_key(moves))
    assert rows(merge_counters(parts.orderBy(F.desc("total")))) == rows(count_by_key(moves))


@pytest.mark.parametrize("previous", [False, True])
def test_snapshots(spark, limit, previous):
    # Windows start at the epoch: 2024-01-01 begins inside the one from 2023-12-31 22:00.
    schema = "branch STRING, company STRING, sku STRING, value STRING, timestamp TIMESTAMP_NTZ"
    at = lambda day, hour, minute=0: datetime(2024, 1, day, hour, minute)
    moves = spark.createDataFrame(
        [
            ("b", "", "before", "1", datetime(2023, 12, 31, 21, 59)),
            ("b", "", "edge", "1", datetime(2023, 12, 31, 22, 0)),
            ("b", "", "last", "1", at(1, 7, 59)),
            ("b", "", "none", "1", at(1, 8)),
            ("b", "", "second", "1", at(1, 18)),
            ("c", "", "gone", "1", at(1, 18)),
            ("b", "", "later", "1", at(3, 0)),
        ],
        schema,
    )
    snapshots = Lookup.measure(
        spark.createDataFrame(
            [("b", datetime(2023, 12, 31, 22), "1"), ("c", datetime(2023, 12, 31, 22), "1"), ("b", at(1, 18), "2")],
            "branch STRING, window TIMESTAMP_NTZ, company STRING",
        ),
        keys=["branch", "window"],
        broadcast_limit=limit,
    )
    found = {r["sku"]: r["company"] for r in enrich_from_snapshot(moves, snapshots, previous=previous).collect()}
    expected = {"edge": "1", "last": "1", "second": "2"}
    assert found == ({**expected, "none": "1", "later": "2"} if previous else expected)


def test_no_snapshots(spark):
    moves = spark.createDataFrame(
        [("b", "", "s", "1", datetime(2024, 1, 1))],
        "branch STRING, company STRING, sku STRING, value STRING, timestamp TIMESTAMP_NTZ",
    )
    none = Lookup.measure(
        spark.createDataFrame([], "branch STRING, window TIMESTAMP_NTZ, company STRING"), keys=["branch", "window"]
    )
    assert enrich_from_snapshot(moves, none, previous=True).count() == 0
    assert enrich_from_snapshot(moves, none).count() == 0


def test_each_branch_has_its_own_newest_snapshot(spark, limit):
    window = lambda n: datetime(2024, 1, 1, 8) + n * timedelta(hours=10)
    moves = spark.createDataFrame(
        [(b, "", f"{b}{n}", "1", window(n) + timedelta(minutes=5)) for b in ("a", "b", "c", None) for n in range(4)]
        + [("a", "7", "assigned", "1", window(3))],
        "branch STRING, company STRING, sku STRING, value STRING, timestamp TIMESTAMP_NTZ",
    )
    snapshots = spark.createDataFrame(
        [("a", window(0), "1"), ("a", window(2), "2"), ("b", window(1), "3"), ("b", window(3), None), ("d", window(0), "4")],
        "branch STRING, window TIMESTAMP_NTZ, company STRING",
    )
    found = {r["sku"]: r["company"] for r in enrich_as_of(moves, snapshots).collect()}
    assert found == {"a0": "1", "a1": "1", "a2": "2", "a3": "2", "b1": "3", "b2": "3", "b3": "3"}
    assert enrich_as_of(moves, snapshots.limit(0)).count() == 0
    assert enrich_as_of(moves.limit(0), snapshots).count() == 0


def test_as_of_merge_sees_a_branch_once_per_window(spark):
    """A branch with a third of all movements is one row per window before it meets its snapshots."""
    moves = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("branch"),
        F.lit("2024-01-01 08:00:00").cast("timestamp_ntz").alias("window"),
    )
    snapshots = moves.select("branch", "window", F.lit("1").alias("company")).distinct()
    resolved = snapshot_as_of(moves, snapshots)
    assert resolved.where("branch = 'hot'").count() == 1 and resolved.count() == 6_001
