"""Native streaming state, redelivery, late rows, incremental overlaps, sketches, bitmaps and point reads."""

from __future__ import annotations

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyline.operators import minute, overlap
from tallyline.operators.counters import stock_movement
from tallyline.operators.parse import accepted, parse_cdc
from tallyline.plans import catalog, inputs, reports
from tallyline.session import folder_bytes, scratch_dir
from tallyline.sources import messages, points
from tallyline.sources.lookup import Lookup, RefreshingLookup
from tallyline.sources.store import STOCK_FAMILIES, WEB_FAMILIES, PartialStore
from tallyline.streaming import late, state
from tallyline.streaming.stock import start_stock_stream
from tallyline.streaming.web import web_batch
from tests.test_plans import plan
from tests.test_streams import CHANGES, LOOKUP, NOW, change, put, rows, visit

SETS = "set_key STRING, member STRING"


@pytest.fixture
def branches(spark):
    return Lookup.measure(spark.createDataFrame([("b1", "1"), ("b2", "2"), ("b3", "1")], LOOKUP))


@pytest.fixture
def native(spark):
    before = {name: spark.conf.get(name, None) for name in state.STATE_STORE}
    state.use_state_store(spark)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_totals_in_state_go_on_after_a_stop(spark, tmp_path, branches, native):
    root = scratch_dir(spark, "test-state")
    store = PartialStore(spark, f"{root}/store", state.STATE_FAMILIES)
    source = str(tmp_path / "in")

    def run():
        stream = messages.stream_messages(spark, source, max_files=1)
        query = state.start_counter_stream(stream, store, branches, f"{root}/checkpoint", trigger=NOW, compact_every=2)
        query.awaitTermination()
        return query

    for number, part in enumerate(CHANGES):
        put(tmp_path / "in", f"{number}.txt", part, number)
        if number == 1:
            continue  # the second and the third file come in one run
        query = run()
        batch = accepted(parse_cdc(messages.read_messages(spark, source)))
        assert rows(state.totals(store)) == rows(stock_movement(batch, branches))
    assert rows(state.totals(store)) == [("b1|1|s", 13), ("b1|1|t", 2), ("b3|1|u", 4)]
    sums = query.recentProgress[-1]["stateOperators"][0]
    assert sums["numRowsTotal"] == 3 and "rocksdbCommitFlushLatency" in sums["customMetrics"]
    assert run().recentProgress == [] or rows(state.totals(store)) == [("b1|1|s", 13), ("b1|1|t", 2), ("b3|1|u", 4)]


def test_a_repeated_batch_leaves_totals_unchanged(spark, branches):
    store = PartialStore(spark, scratch_dir(spark, "test-totals"), state.STATE_FAMILIES)
    process = state.write_totals(store, "run", compact_every=3)
    made = lambda *pairs: spark.createDataFrame(list(pairs), "counter_key STRING, total BIGINT")
    for number, pairs in [(0, [("a", 1), ("b", 5)]), (1, [("a", 3)]), (1, [("a", 3)]), (2, [("a", 2)]), (3, [("c", 9)]), (3, [("c", 9)])]:
        process(made(*pairs), number)
    assert rows(state.totals(store)) == [("a", 2), ("b", 5), ("c", 9)]
    assert [(p.first, p.last) for p in store.live("totals")] == [(0, 2), (3, 3)]


def test_a_redelivered_message_counts_once(spark, tmp_path, branches):
    schema = "id STRING, published TIMESTAMP_NTZ, value STRING"
    at = lambda m: datetime(2024, 1, 1, 0, m)
    sent = [("m1", at(0), change("b1", "s", 5)), ("m2", at(1), change("b1", "s", 5)), ("m3", at(9), change("b3", "u", 1))]
    files = [[sent[0], sent[0]], [sent[1]], [sent[0], sent[1]], [sent[2]], [sent[2], sent[1]]]
    path = f"{tmp_path}/in"
    for part in files:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    stream = messages.stream_table(spark, path, max_files=1)
    once = messages.drop_redelivered(stream, "id", "published", "10 minutes")
    query = once.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(**NOW).start()
    query.awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("id")) == [("m1",), ("m2",), ("m3",)]


def test_redelivery_state_is_bounded(spark, tmp_path):
    """Ids far behind the newest time are forgotten."""
    schema = "id STRING, published TIMESTAMP_NTZ"
    for hour in range(5):
        part = [(f"{hour}-{i}", datetime(2024, 1, 1, hour)) for i in range(10)]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = messages.stream_table(spark, f"{tmp_path}/in", max_files=1)
    once = messages.drop_redelivered(stream, "id", "published", "30 minutes")
    query = once.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(**NOW).start()
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 20


def test_a_delivery_is_one_batch_of_many_files(spark, monkeypatch):
    """Also a delivery that is stored in fewer pieces than the largest, and one without messages."""
    sent = spark.range(0, 20_000, numPartitions=8).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), "id")
    sent = sent.toDF("message_id", "number")
    part = F.when(F.col("number") < 5, 1).otherwise(0)
    monkeypatch.setattr(catalog, "MESSAGE_FILE_BYTES", 200_000)
    stored, files = catalog._message_parts(sent, part)
    root = scratch_dir(spark, "test-deliveries")
    catalog._message_files(stored, files, root, [0, 1, 2, 0])
    made = spark.read.parquet(root).groupBy(F.input_file_name().alias("file")).count().collect()
    assert files >= 4 and len(made) == 2 * files + 1
    assert max(row["count"] for row in made) < 19_995 / 2
    batches = []
    stream = messages.stream_table(spark, root, max_files=files).writeStream.trigger(**NOW)
    stream = stream.foreachBatch(lambda rows, _: batches.append((rows.count(), rows.agg(F.sum("number")).first()[0])))
    stream.option("checkpointLocation", scratch_dir(spark, "test-deliveries")).start().awaitTermination()
    most = (19_995, sum(range(5, 20_000)))
    assert batches == [most, (5, 10), (0, None), most]


def test_ids_of_any_kind_are_told_apart_and_come_out_as_they_were(spark, tmp_path):
    ids = ["", "ab", "AB", "aB", "abc", "0", "00", "\x00", "x", "\u00e9", "ab ", "0a1b" * 16, None]
    for again in range(2):
        part = [(i, datetime(2024, 1, 1)) for i in (ids if again else ids[::-1])]
        spark.createDataFrame(part, "id STRING, published TIMESTAMP_NTZ").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    once = messages.drop_redelivered(messages.stream_table(spark, f"{tmp_path}/in", max_files=1), "id", "published", "10 minutes")
    assert once.schema["id"].dataType.simpleString() == "string"
    query = once.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(**NOW).start()
    query.awaitTermination()
    assert sorted(repr(r["id"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(map(repr, ids))


def _shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in found.mkString("\n").split("\n") if "/shuffle_" in name}


def test_redelivery_takes_room_for_packed_ids_and_one_batch(spark, branches):
    """An id of 64 digits takes less than 64 bytes in state, and no shuffle of a batch is left."""
    root, size = scratch_dir(spark, "test-room"), 20_000
    sent = spark.range(size, numPartitions=1).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("published"),
        F.lit(change("b1", "s", 1)).alias("value"),
    )
    for _ in range(3):
        sent.write.mode("append").parquet(f"{root}/in")
    once = messages.drop_redelivered(messages.stream_table(spark, f"{root}/in", max_files=1), "id", "published", "10 minutes")
    store = PartialStore(spark, f"{root}/store", STOCK_FAMILIES)
    lookup = RefreshingLookup(lambda: branches.rows)
    before = _shuffle_files(spark)
    start_stock_stream(once.select("value"), store, lookup, f"{root}/checkpoint", trigger=NOW).awaitTermination()
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert folder_bytes(spark, f"{root}/checkpoint/state") < 60 * size
    assert rows(store.read("counters")) == [("b1|1|s", size)]


def test_deliveries_take_the_room_of_lines(spark, sf_dir, monkeypatch):
    """Not that of the messages made of them, of which each has an id of 64 digits beside its text."""
    read, stream_table = [], messages.stream_table
    monkeypatch.setattr(messages, "stream_table", lambda spark, path, max_files: read.append(path) or stream_table(spark, path, max_files))
    catalog.QUERIES["stream_redelivered"](spark, sf_dir)
    assert folder_bytes(spark, read[0]) < 2 * 60 * inputs.table(spark, sf_dir, "lineitem").count()


@pytest.mark.parametrize("name", ["stream_counters_stateful", "stream_redelivered", "stream_late_rows"])
def test_large_deliveries_are_not_written_by_one_task(spark, sf_dir, monkeypatch, name):
    """With tables and files of small pieces, the results are those of whole deliveries."""
    want = rows(catalog.QUERIES[name](spark, sf_dir))
    table = inputs.table
    monkeypatch.setattr(inputs, "table", lambda *given: table(*given).repartition(8))
    monkeypatch.setattr(catalog, "MESSAGE_FILE_BYTES", 10_000)
    made = []
    stream_table = messages.stream_table
    monkeypatch.setattr(messages, "stream_table", lambda spark, path, max_files: made.append(max_files) or stream_table(spark, path, max_files))
    assert rows(catalog.QUERIES[name](spark, sf_dir)) == want
    assert min(made) > 1


@pytest.mark.parametrize("replayed", [False, True])
def test_late_rows_are_told_apart(spark, replayed):
    store = PartialStore(spark, scratch_dir(spark, "test-late"), late.LATE_FAMILIES)
    process = late.late_batch(store, "run", timedelta(minutes=1), compact_every=2)
    at = lambda m, s=0: datetime(2024, 1, 1, 0, m, s)
    batches = [[at(0, 10), at(5)], [at(3, 59), at(4), at(0, 20)], [None], [at(4, 1), at(3, 1), at(9)], [at(7, 30)]]
    for number, times in enumerate(batches):
        frame = spark.createDataFrame([(t,) for t in times], "timestamp TIMESTAMP_NTZ")
        for _ in range(2 if replayed else 1):
            process(frame, number)
    # The newest time is 00:05 until the fourth batch: minutes up to 3 have ended by 00:04.
    told = {r["minute"]: (r["on_time"], r["late"]) for r in late.visits_on_time_and_late(store).collect()}
    assert told == {at(0): (1, 1), at(3): (0, 2), at(4): (2, 0), at(5): (1, 0), at(7): (0, 1), at(9): (1, 0), None: (1, 0)}
    assert sum(a + b for a, b in told.values()) == sum(map(len, batches))


def made_sets(rng, n):
    return [(f"set_var_{rng.choice('abcde')}", str(rng.randrange(40))) for _ in range(n)] + [("setXvar_a", "1")]


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_overlap_equals_recomputation(spark, seed):
    rng = random.Random(seed)
    store = PartialStore(spark, scratch_dir(spark, "test-delta"), WEB_FAMILIES)
    seen = spark.createDataFrame([], SETS)
    for number in range(4):
        batch = spark.createDataFrame(made_sets(rng, 25), SETS)
        new = overlap.merge_sets(batch)
        store.write("overlap", overlap.overlap_delta(new, store.partials("variant_users")), "run", number)
        store.write("variant_users", new, "run", number)
        if number == 2:
            store.compact("run", 3)
        seen = seen.unionAll(batch)
        assert rows(reports.variants_overlap(store)) == rows(overlap.variant_overlap(seen))
    sizes = store.read("overlap").where("dim_a = dim_b").select("dim_a", "users")
    want = overlap.merge_sets(seen).where("startswith(set_key, 'set_var_')").groupBy(F.substr("set_key", F.lit(9)).alias("v")).count()
    assert rows(sizes) == rows(want)
    text = plan(reports.variants_overlap(store))
    assert "/overlap/" in text and "variant_users" not in text and "member" not in text


def test_replayed_web_batch_changes_no_overlap(spark):
    store = PartialStore(spark, scratch_dir(spark, "test-web-delta"), WEB_FAMILIES)
    process = web_batch(store, "run")
    from tallyline.operators.parse import parse_web

    texts = [[visit(1, 5, "x", "2024-01-01T00:00:10Z")], [visit(1, 5, "y", "2024-01-01T00:00:10Z"), visit(2, 5, "y", "2024-01-01T00:00:11Z")]]
    for number in (0, 0, 1, 1):
        process(parse_web(spark.createDataFrame([(t,) for t in texts[number]], "value STRING")), number)
    assert rows(reports.variants_overlap(store)) == [("x", "y", 1.0)]


def test_sketch_overlap_of_large_sets(spark):
    """Sets far beyond what a sketch holds exactly, from partial sketches, within the error of their size."""
    ids = spark.range(200_000)
    sets = ids.selectExpr("'set_var_a' AS set_key", "CAST(id AS STRING) AS member").unionAll(
        ids.where("id % 2 = 0").selectExpr("'set_var_b'", "CAST(id AS STRING)")
    ).unionAll(ids.selectExpr("'set_var_c'", "CONCAT('c', id)"))
    partials = overlap.set_sketches(sets.withColumn("part", F.pmod(F.xxhash64("member"), F.lit(5))), "part")
    assert partials.count() == 15
    merged = overlap.merge_sketches(partials)
    assert merged.agg(F.max(F.octet_length("sketch"))).first()[0] < 150_000
    found = {(r["dim_a"], r["dim_b"]): r["approximate"] for r in overlap.sketch_overlap(merged).collect()}
    assert found[("a", "b")] == pytest.approx(100_000, rel=0.05)
    assert found[("a", "c")] == found[("b", "c")] == 0


def test_bitmaps_are_exact_and_bounded(spark):
    """Large, small and negative numbers, merged from partials; rows per minute do not grow with events."""
    numbers = [0, 1, 1, 32_767, 32_768, 32_769, -5, 2**31 - 1, None]
    rows_in = [(n, datetime(2024, 1, 1, 0, m, s)) for n in numbers for m in (0, 1) for s in (1, 2, 3) if m or n != 1]
    events = spark.createDataFrame(rows_in, "experiment_id INT, timestamp TIMESTAMP_NTZ").repartition(4)
    partials = minute.experiment_bitmaps(events.withColumn("part", F.col("timestamp").cast("string").substr(-1, 1)), "part")
    counts = minute.experiment_counts(minute.merge_experiments(partials.drop("part")))
    assert rows(counts) == [(datetime(2024, 1, 1), 6), (datetime(2024, 1, 1, 0, 1), 7)]
    many = spark.range(50_000).selectExpr("CAST(1 + id % 30000 AS INT) AS experiment_id", "TIMESTAMP_NTZ'2024-01-01' AS timestamp")
    assert minute.experiment_bitmaps(many).count() == 1
    assert minute.experiment_counts(minute.experiment_bitmaps(many)).first()["metric"] == 30_000


def test_point_reads(spark):
    path = scratch_dir(spark, "points")
    counters = spark.range(0, 40_000, 1, 8).selectExpr("CONCAT('k', LPAD(CAST(id * 2 AS STRING), 6, '0')) AS counter_key", "id AS total")
    points.store_sorted(counters, path)
    keys = ["k000010", "k000011", "k079998", "nowhere", "k000010"]
    found = points.read_keys(spark, path, keys)
    assert [tuple(r) for r in found.collect()] == [(0, "k000010", 5), (1, "k000011", 0), (2, "k079998", 39_999), (3, "nowhere", 0), (4, "k000010", 5)]
    assert points.read_keys(spark, path, []).collect() == []
    with pytest.raises(ValueError, match="1001 keys"):
        points.read_keys(spark, path, ["k"] * 1001)


def test_point_read_skips_files_and_row_groups(spark):
    """An absent key within the range of a file opens none of its row groups, thanks to the Bloom filter."""
    path = scratch_dir(spark, "points-skip")
    counters = spark.range(0, 40_000, 1, 8).selectExpr("CONCAT('k', LPAD(CAST(id * 2 AS STRING), 6, '0')) AS counter_key", "id AS total")
    points.store_sorted(counters, path)

    def rows_read(*keys):
        frame = spark.read.parquet(path).where(F.col("counter_key").isin(list(keys)))
        executed = frame._jdf.queryExecution().executedPlan()
        frame._jdf.queryExecution().toRdd().count()
        return executed.collectLeaves().apply(0).metrics().apply("numOutputRows").value()

    assert rows_read("k000011") == 0
    assert 0 < rows_read("k000010") < 40_000
    assert "In(counter_key" in plan(points.read_keys(spark, path, ["a", "b"])) or "Or(EqualTo(counter_key" in plan(points.read_keys(spark, path, ["a", "b"]))


def test_goal_before_exposure_does_not_count(spark):
    at = lambda m: datetime(2024, 1, 1, 0, m)
    events = spark.createDataFrame(
        [
            (1, 7, "a", at(1)), (1, 7, "goal", at(2)),
            (2, 7, "goal", at(1)), (2, 7, "a", at(2)),
            (3, 7, "a", at(1)), (3, 8, "goal", at(2)),
            (4, 7, "a", at(3)), (4, 7, "b", at(1)), (4, 7, "goal", at(2)),
            (5, 7, "a", at(1)), (5, 7, "goal", at(1)),
            (6, 7, "goal", at(1)), (6, 7, "a", at(2)), (6, 7, "goal", at(3)),
            (None, 7, "a", at(1)), (None, 7, "goal", at(2)), (7, None, "a", at(1)), (7, None, "goal", at(2)),
        ],
        "uid BIGINT, experiment_id INT, variant STRING, timestamp TIMESTAMP_NTZ",
    )
    found = {(r["experiment_id"], r["variant"]): (r["users"], r["converted"], r["rate"]) for r in overlap.ordered_conversion(events, "goal").collect()}
    assert found == {(7, "a"): (6, 2, 2 / 6), (7, "b"): (1, 1, 1.0), (None, "a"): (1, 1, 1.0)}
