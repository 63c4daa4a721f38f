"""Stores and streams: a stream equals the batch, whatever the order, lateness and replays."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyline.functions.time import trailing_minutes
from tallyline.operators import minute, overlap, parse
from tallyline.operators.counters import count_by_key, stock_movement
from tallyline.plans import inputs, reports
from tallyline.plans.catalog import QUERIES
from tallyline.session import remove, scratch_dir
from tallyline.sources.lookup import Lookup, RefreshingLookup
from tallyline.sources.messages import read_messages, stream_messages, stream_table
from tallyline.sources.store import STOCK_FAMILIES, WEB_FAMILIES, PartialStore
from tallyline.streaming.stock import start_stock_stream, stock_batch
from tallyline.streaming.web import closed_minutes, start_web_stream, web_batch
from tests.test_plans import plan

NOW = {"availableNow": True}
LOOKUP = "branch STRING, company STRING"


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def change(branch, sku, value):
    return json.dumps({"after": {"branch_id_no": branch, "sku_no": sku, "value": value}, "op": "c", "ts_ms": 1})


def visit(uid, experiment, variant, moment):
    return json.dumps({"uid": uid, "experiment_id": experiment, "variant": variant, "timestamp": moment})


def test_batch_is_kept_as_it_is(spark, tmp_path, monkeypatch):
    """The batch's rows are not encoded while they are kept, and the session's own setting stays."""
    setting = "spark.sql.inMemoryColumnarStorage.compressed"
    seen = []
    write = PartialStore.write

    def look(self, table, partials, *batch):
        leaves = partials._jdf.queryExecution().withCachedData().collectLeaves()
        found = [leaves.apply(i) for i in range(leaves.size())]
        seen.extend(leaf.cacheBuilder().cachedPlan().conf().useCompression() for leaf in found if leaf.nodeName() == "InMemoryRelation")
        write(self, table, partials, *batch)

    monkeypatch.setattr(PartialStore, "write", look)
    before = spark.conf.get(setting)
    store = PartialStore(spark, str(tmp_path / "store"), STOCK_FAMILIES)
    branches = RefreshingLookup(lambda: spark.createDataFrame([("b1", "1")], LOOKUP))
    texts = spark.createDataFrame([(change("b1", "s", 4),), (change("b2", "s", 1),), ("x",)], "value STRING")
    stock_batch(store, branches, "run")(parse.parse_cdc(texts), 0)
    assert seen and not any(seen) and spark.conf.get(setting) == before
    assert rows(store.read("counters")) == [("b1|1|s", 4)]
    assert rows(store.read("misses")) == [("b2", 1)] and rows(store.read("rejects")) == [("malformed", 1)]


def put(folder, name, texts, position=0):
    """A whole file with a time of its own, which is the order the source takes files in."""
    folder.mkdir(exist_ok=True)
    hidden = folder / f".{name}"
    hidden.write_text("\n".join(texts) + "\n")
    os.utime(hidden, (1_700_000_000 + 60 * position,) * 2)
    hidden.rename(folder / name)


CHANGES = [
    [change("b1", "s", 5), change("b1", "t", 2), "not json", change("b9", "s", 1)],
    [change("b1", "s", -2), change("b2", "s", 7), change("b1", "s", 1.5)],
    [change("b1", "s", 10), change("b3", "u", 4), "{}"],
]


@pytest.fixture
def branches(spark):
    return RefreshingLookup(
        lambda: spark.createDataFrame([("b1", "1"), ("b2", "2"), ("b3", "1")], LOOKUP)
    )


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1]])
def test_stock_stream_equals_batch(spark, tmp_path, branches, order):
    for position, part in enumerate(order):
        put(tmp_path / "in", f"{position}.txt", CHANGES[part], position)
    root = scratch_dir(spark, "test-stock")
    store = PartialStore(spark, f"{root}/store", STOCK_FAMILIES)
    query = start_stock_stream(
        stream_messages(spark, str(tmp_path / "in"), max_files=1), store, branches, f"{root}/checkpoint",
        trigger=NOW, dead_letters=f"{root}/dead", compact_every=2,
    )
    query.awaitTermination()
    batch = parse.parse_cdc(read_messages(spark, str(tmp_path / "in")))
    assert rows(store.read("counters")) == rows(stock_movement(parse.accepted(batch), branches.get()))
    assert rows(store.read("counters")) == [("b1|1|s", 13), ("b1|1|t", 2), ("b3|1|u", 4)]
    assert rows(store.read("rejects")) == [("bad_value", 1), ("malformed", 1), ("missing_field", 1)]
    assert rows(store.read("misses")) == [("b9", 1)]
    dead = spark.read.parquet(f"{root}/dead").select("reason", "message")
    assert rows(dead) == rows(parse.rejected(batch))
    assert [(p.first, p.last) for p in store.live("counters")] == [(0, 1), (2, 2)]
    progress = [p["observedMetrics"]["messages"] for p in query.recentProgress if p["observedMetrics"]]
    assert (sum(m["read"] for m in progress), sum(m["unusable"] for m in progress)) == (10, 3)


def test_table_stream_in_small_batches(spark, sf_dir, tmp_path, branches):
    path = str(tmp_path / "lineitem.parquet")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(4).write.parquet(path)
    (tmp_path / "lineitem.parquet.old").mkdir()
    root = scratch_dir(spark, "test-table")
    store = PartialStore(spark, f"{root}/store", STOCK_FAMILIES)
    suppliers = inputs.branch_lookup(spark.read.parquet(f"{sf_dir}/supplier.parquet"))
    query = start_stock_stream(
        inputs.cdc_messages(stream_table(spark, path, max_bytes=1)), store, RefreshingLookup(lambda: suppliers),
        f"{root}/checkpoint", trigger=NOW, compact_every=3,
    )
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert rows(store.read("counters")) == rows(QUERIES["stock_movement"](spark, sf_dir))
    assert [(p.first, p.last) for p in store.live("counters")] == [(0, 2), (3, 3)]


def test_stream_goes_on_after_a_stop(spark, tmp_path, branches):
    root = scratch_dir(spark, "test-restart")
    store = PartialStore(spark, f"{root}/store", STOCK_FAMILIES)
    for number, part in enumerate(CHANGES):
        put(tmp_path / "in", f"{number}.txt", part, number)
        start_stock_stream(
            stream_messages(spark, str(tmp_path / "in")), store, branches, f"{root}/checkpoint", trigger=NOW
        ).awaitTermination()
    assert rows(store.read("counters")) == [("b1|1|s", 13), ("b1|1|t", 2), ("b3|1|u", 4)]


def test_replay_does_not_count_twice(spark, branches):
    store = PartialStore(spark, scratch_dir(spark, "test-replay"), STOCK_FAMILIES)
    process = stock_batch(store, branches, "run", compact_every=2)
    texts = [spark.createDataFrame([(t,) for t in part], "value STRING") for part in CHANGES]
    for number in (0, 0, 1, 1, 2, 2, 2):
        process(parse.parse_cdc(texts[number]), number)
    assert rows(store.read("counters")) == [("b1|1|s", 13), ("b1|1|t", 2), ("b3|1|u", 4)]
    assert rows(store.read("rejects")) == [("bad_value", 1), ("malformed", 1), ("missing_field", 1)]


def test_compaction_keeps_totals_and_survives_a_crash(spark, monkeypatch):
    store = PartialStore(spark, scratch_dir(spark, "test-compact"), STOCK_FAMILIES)
    add = lambda n, total, run="run": store.write(
        "counters", spark.createDataFrame([("k", total)], "counter_key STRING, total BIGINT"), run, n
    )
    live = lambda: [(p.run, p.first, p.last) for p in store.live("counters")]
    add(0, 1)
    add(1, 2)
    add(2, 100)  # left behind by a failed attempt at batch 2
    half = f"{store.root}/counters/run=run/first=0/last=1"
    spark.createDataFrame([("k", 3)], "counter_key STRING, total BIGINT").write.parquet(half)
    remove(spark, f"{half}/_SUCCESS")  # a compaction that never finished
    assert live() == [("run", 0, 0), ("run", 1, 1), ("run", 2, 2)]
    store.compact("run", 2)
    assert live() == [("run", 0, 1), ("run", 2, 2)]
    assert rows(store.read("counters")) == [("k", 103)]
    add(2, 4)
    assert rows(store.read("counters")) == [("k", 7)]
    # Another run counts on its own, and is compacted on its own.
    add(2, 10, "other")
    add(3, 1)
    store.compact("run", 4)
    assert live() == [("other", 2, 2), ("run", 0, 1), ("run", 2, 3)]
    assert {(p.first, p.last) for p in store.parts("counters") if p.run == "run"} == {(0, 1), (2, 2), (3, 3), (2, 3)}, "for readers"
    store.compact("run", 4, full=True)
    assert live() == [("other", 2, 2), ("run", 0, 3)]
    assert rows(store.read("counters")) == [("k", 18)]
    assert rows(store.partials("counters", [p for p in store.live("counters") if p.run == "run"])) == [("k", 8)]


def test_replaced_batch_leaves_no_old_day(spark):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store = PartialStore(spark, scratch_dir(spark, "test-days"), WEB_FAMILIES)
        for moment in (datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 5)):
            frame = spark.createDataFrame([(moment, 1)], "minute TIMESTAMP_NTZ, visits BIGINT")
            frame = frame.withColumn("users", F.lit(None).cast("binary"))
            store.write("minutes", frame, "run", 0)
        assert rows(store.read("minutes").select("minute", "visits")) == [(datetime(2024, 1, 2, 5), 1)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_empty_store(spark):
    store = PartialStore(spark, scratch_dir(spark, "test-empty"), WEB_FAMILIES)
    asof = datetime(2024, 1, 1)
    assert [r["metric"] for r in reports.visits(store, 2, asof).collect()] == [0.0, 0.0]
    assert [r["metric"] for r in reports.users(store, 2, asof).collect()] == [0.0, 0.0]
    assert [r["metric"] for r in reports.experiments(store, 2, asof).collect()] == [0.0, 0.0]
    assert reports.variants_overlap(store).count() == 0


def test_empty_stream(spark, tmp_path, branches):
    (tmp_path / "in").mkdir()
    root = scratch_dir(spark, "test-nothing")
    store = PartialStore(spark, f"{root}/store", STOCK_FAMILIES)
    start_stock_stream(
        stream_messages(spark, str(tmp_path / "in")), store, branches, f"{root}/checkpoint", trigger=NOW
    ).awaitTermination()
    assert store.read("counters").count() == 0


def test_lookup_changes_between_batches(spark):
    now, company = [0.0], ["2"]
    branches = RefreshingLookup(
        lambda: spark.createDataFrame([("b1", company[0])], LOOKUP), ttl=10, clock=lambda: now[0]
    )
    store = PartialStore(spark, scratch_dir(spark, "test-ttl"), STOCK_FAMILIES)
    process = stock_batch(store, branches, "run")
    message = parse.parse_cdc(spark.createDataFrame([(change("b1", "s", 1),)], "value STRING"))
    process(message, 0)
    company[0] = "1"
    process(message, 1)
    assert store.read("counters").count() == 0
    now[0] = 11.0
    process(message, 2)
    assert rows(store.read("counters")) == [("b1|1|s", 1)]


VISITS = [
    [visit(1, 5, "default", "2024-01-01T00:00:10Z"), visit(2, 5, "1", "2024-01-01T00:01:00Z")],
    [visit(1, 6, "1", "2024-01-01T00:01:59Z"), "broken", visit(3, 5, "2", "2024-01-01T00:02:00Z")],
    # Late: its minute has long been written.
    [visit(4, 7, "default", "2024-01-01T00:00:59Z"), visit(1, 5, "default", "2024-01-01T00:00:10Z")],
]
ASOF = datetime(2024, 1, 1, 0, 3)


def check_web(spark, store, events):
    axis = trailing_minutes(spark, 5, ASOF)
    parts = minute.minute_partials(events)
    assert rows(reports.visits(store, 5, ASOF)) == rows(minute.visits_report(axis, parts))
    assert rows(reports.users(store, 5, ASOF)) == rows(minute.users_report(axis, parts))
    live = minute.experiments_report(axis, minute.experiment_bitmaps(events))
    assert rows(reports.experiments(store, 5, ASOF)) == rows(live)
    common = overlap.variant_overlap(overlap.variant_users(events))
    assert rows(reports.variants_overlap(store)) == rows(common)


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0]])
def test_web_stream_equals_batch(spark, tmp_path, order):
    for position, part in enumerate(order):
        put(tmp_path / "in", f"{position}.txt", VISITS[part], position)
    root = scratch_dir(spark, "test-web")
    store = PartialStore(spark, f"{root}/store", WEB_FAMILIES)
    start_web_stream(
        stream_messages(spark, str(tmp_path / "in"), max_files=1), store, f"{root}/checkpoint", trigger=NOW, compact_every=2
    ).awaitTermination()
    events = parse.accepted(parse.parse_web(read_messages(spark, str(tmp_path / "in"))))
    check_web(spark, store, events)
    found = {r["timestamp"].minute: r["metric"] for r in reports.visits(store, 3, ASOF).collect()}
    assert found == {0: 3.0, 1: 2.0, 2: 1.0}
    assert rows(store.read("rejects")) == [("malformed", 1)]


def test_web_replay(spark):
    store = PartialStore(spark, scratch_dir(spark, "test-web-replay"), WEB_FAMILIES)
    process = web_batch(store, "run")
    texts = [spark.createDataFrame([(t,) for t in part], "value STRING") for part in VISITS]
    for number in (0, 0, 1, 2, 2):
        process(parse.parse_web(texts[number]), number)
    check_web(spark, store, parse.accepted(parse.parse_web(texts[0].unionAll(texts[1]).unionAll(texts[2]))))


def test_report_reads_the_minutes_it_needs(spark):
    store = PartialStore(spark, scratch_dir(spark, "test-prune"), WEB_FAMILIES)
    events = spark.range(10).select(
        F.col("id").alias("uid"), F.lit(1).alias("experiment_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("timestamp"),
    )
    for number in range(3):
        store.write("minutes", minute.minute_partials(events), "run", number)
    store.compact("run", 2)
    report = reports.visits(store, 10, datetime(2024, 1, 3, 0, 5))
    assert rows(report.where("metric > 0")) == [(datetime(2024, 1, 3), 3.0)]
    assert "GreaterThanOrEqual(minute,2024-01-02" in plan(report)
    merged = spark.read.parquet(f"{store.root}/minutes/run=run/first=0/last=1")
    spans = merged.groupBy(F.input_file_name().alias("file")).agg(F.min("minute").alias("low"), F.max("minute").alias("high"))
    spans = spans.orderBy("low").collect()
    assert all(a["high"] < b["low"] for a, b in zip(spans, spans[1:])), "files hold ranges of minutes"


def test_unfinished_batch_files_are_not_read(spark):
    """What a task has written of a batch that never finished is below a folder that readers leave out."""
    store = PartialStore(spark, scratch_dir(spark, "test-unfinished"), STOCK_FAMILIES)
    moves = spark.createDataFrame([("b", "1", "s", "2")], "branch STRING, company STRING, sku STRING, value STRING")
    store.write("counters", count_by_key(moves), "run", 0)
    half = f"{store.root}/counters/run=run/first=1/last=1/_temporary/0/task_0"
    count_by_key(moves).write.parquet(half)
    assert rows(store.read("counters")) == [("b|1|s", 2)]


def test_closed_minutes_drop_what_is_too_late(spark, tmp_path):
    root = scratch_dir(spark, "test-closed")
    seen = [["00:00:10", "00:02:00"], ["00:01:40"], ["00:00:20"]]
    for position, times in enumerate(seen):
        put(tmp_path / "in", f"{position}.txt", [visit(1, 5, "1", f"2024-01-01T{t}Z") for t in times], position)
    messages = stream_messages(spark, str(tmp_path / "in"), max_files=1)
    (
        closed_minutes(parse.accepted(parse.parse_web(messages)), "30 seconds")
        .writeStream.format("parquet")
        .option("path", f"{root}/minutes")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**NOW)
        .start()
        .awaitTermination()
    )
    found = rows(spark.read.schema("minute TIMESTAMP_NTZ, visits BIGINT").parquet(f"{root}/minutes"))
    # The first file moves the mark to 00:01:30, which closes minute 0; minutes 1 and 2 stay open.
    assert found == [(datetime(2024, 1, 1), 1)]


@pytest.mark.parametrize("cut", ["one file", "shuffled", "reversed"])
def test_closed_minutes_of_the_store_do_not_depend_on_batches(spark, tmp_path, cut):
    """An hour of events, some of them an hour late: the same minutes as one batch, six batches, or six in reverse."""
    times = [f"2024-01-01T{h:02d}:{m:02d}:{(7 * m) % 60:02d}Z" for h in (0, 1) for m in range(0, 60, 3)]
    texts = [visit(i, i % 3, "1", t) for i, t in enumerate(times)]
    parts = [texts] if cut == "one file" else [texts[i::6] for i in range(6)] if cut == "shuffled" else [texts[i : i + 7] for i in range(35, -1, -7)]
    for position, part in enumerate(parts):
        put(tmp_path / "in", f"{position}.txt", part, position)
    root = scratch_dir(spark, "test-closed-store")
    store = PartialStore(spark, f"{root}/store", WEB_FAMILIES)
    start_web_stream(
        stream_messages(spark, str(tmp_path / "in"), max_files=1), store, f"{root}/checkpoint", trigger=NOW, compact_every=2
    ).awaitTermination()
    want = [(datetime(2024, 1, 1, 0, m), 1) for m in range(0, 57, 3)]
    assert rows(reports.closed_minutes(store, minutes=60)) == want


def test_rejects_are_kept_by_default(spark, tmp_path, branches):
    put(tmp_path / "in", "0.txt", CHANGES[0] + ["{}"])
    root = scratch_dir(spark, "test-rejects")
    stock = PartialStore(spark, f"{root}/stock", STOCK_FAMILIES)
    web = PartialStore(spark, f"{root}/web", WEB_FAMILIES)
    start_stock_stream(stream_messages(spark, str(tmp_path / "in")), stock, branches, f"{root}/c1", trigger=NOW).awaitTermination()
    start_web_stream(stream_messages(spark, str(tmp_path / "in")), web, f"{root}/c2", trigger=NOW).awaitTermination()
    assert rows(stock.rejected_messages()) == [("malformed", "not json"), ("missing_field", "{}")]
    assert len(rows(web.rejected_messages())) == 5 and ("malformed", "not json") in rows(web.rejected_messages())


def test_several_partials_of_a_key_in_one_batch(spark):
    store = PartialStore(spark, scratch_dir(spark, "test-many"), STOCK_FAMILIES)
    moves = spark.range(100).selectExpr(
        "CAST(id % 3 AS STRING) AS branch", "'1' AS company", "'s' AS sku", "'2' AS value", "id % 4 AS batch_id"
    )
    for _ in range(2):
        store.write("counters", count_by_key(moves, "batch_id").drop("batch_id"), "history", 0)
    assert rows(store.read("counters")) == rows(count_by_key(moves))


def test_lookup_measure_is_reused(spark, branches):
    assert isinstance(branches.get(), Lookup) and branches.get() is branches.get()
