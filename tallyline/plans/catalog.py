"""One query per operator, over the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import keys, time
from tallyline.operators import counters, enrich, minute, overlap, parse, route
from tallyline.plans import inputs, reports
from tallyline.session import folder_bytes, matching, materialize, materialize_at, scratch_dir
from tallyline.sources import lookup, messages, points, store
from tallyline.streaming import late, state, stock, web

Query = Callable[[SparkSession, str], DataFrame]

# Minutes of the reports: one day.
REPORT_MINUTES = 1440
GOAL = "purchase"
AVAILABLE_NOW = {"availableNow": True}

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register under the function's own name. No query depends on the session's time zone or changes it."""
    QUERIES[run.__name__] = run
    return run


# Inputs shared by several queries


def _movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.accepted(parse.parse_cdc(inputs.change_messages(spark, sf_dir)))


def _branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.branch_lookup(inputs.table(spark, sf_dir, "supplier"))


def _lookup(spark: SparkSession, sf_dir: str) -> lookup.Lookup:
    return lookup.Lookup.measure(_branches(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.web_events(inputs.table(spark, sf_dir, "events"))


def _sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.order_sets(inputs.table(spark, sf_dir, "orders"))


# Messages


@query
def event_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages from a text source, counted per operation."""
    path = scratch_dir(spark, "messages")
    inputs.change_messages(spark, sf_dir).write.text(path)
    op = F.get_json_object("value", "$.op").alias("op")
    return messages.read_messages(spark, path).groupBy(op).agg(F.count("*").alias("n"))


@query
def cdc_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _movements(spark, sf_dir)


@query
def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.reject_counts(parse.parse_cdc(inputs.damaged_cdc_messages(spark, sf_dir)))


@query
def web_event_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.accepted(parse.parse_web(inputs.visit_messages(spark, sf_dir)))


# Lookup


@query
def lookup_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _branches(spark, sf_dir)


@query
def lookup_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the company as the key, so that there are duplicates."""
    table = inputs.table(spark, sf_dir, "supplier").select(
        (F.col("s_nationkey") % 3).alias("branch_id"), F.col("s_suppkey").alias("cpy_id")
    )
    return lookup.lookup_duplicates(lookup.scan_lookup(table))


@query
def enrich_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(_movements(spark, sf_dir), _lookup(spark, sf_dir))


@query
def enrich_company_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken for a lookup that is too large to replicate."""
    large = lookup.Lookup.measure(_branches(spark, sf_dir), broadcast_limit=0)
    return enrich.enrich(_movements(spark, sf_dir), large)


@query
def enrich_company_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup too large to replicate, stored in buckets of its key: only the movements are shuffled."""
    large = lookup.Lookup.measure(_branches(spark, sf_dir), broadcast_limit=0)
    stored = lookup.store_bucketed(large, f"branches_{uuid.uuid4().hex}")
    return enrich.enrich(_movements(spark, sf_dir), stored)


@query
def lookup_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.lookup_misses(_movements(spark, sf_dir), _lookup(spark, sf_dir))


@query
def tumbling_10h(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    start = enrich.snapshot_window("ts").alias("window_start")
    return events.groupBy(start).agg(F.count("*").alias("n"))


def _snapshots(movements: DataFrame, every: bool) -> lookup.Lookup:
    """A table of lookup snapshots without branch 9, the company changing each time.

    Unless ``every``, two windows in five have no snapshot.
    """
    number = (F.unix_seconds(time.utc_instant("window")) / 36000).cast("bigint")
    rows = (
        movements.select("branch", enrich.snapshot_window("timestamp").alias("window"))
        .where("branch <> '9'")
        .distinct()
        .withColumn("company", ((F.col("branch").cast("bigint") + number) % 3).cast("string"))
    )
    taken = materialize(rows if every else rows.where(number % 5 < 3), "snapshots")
    return lookup.Lookup.measure(taken, keys=["branch", "window"])


def _from_snapshots(spark: SparkSession, sf_dir: str, every: bool) -> DataFrame:
    movements = inputs.branch_movements(inputs.table(spark, sf_dir, "events"))
    found = enrich.enrich_from_snapshot(movements, _snapshots(movements, every), previous=not every)
    return found.select("event_id", "branch", "company")


@query
def enrich_windowed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_snapshots(spark, sf_dir, every=True)


@query
def enrich_previous_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_snapshots(spark, sf_dir, every=False)


@query
def enrich_branch_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From snapshots that lack single branches, in which each branch uses its own newest one."""
    movements = inputs.branch_movements(inputs.table(spark, sf_dir, "events"))
    number = (F.unix_seconds(time.utc_instant("window")) / 36000).cast("bigint")
    taken = _snapshots(movements, every=True).rows.where((F.col("branch").cast("bigint") + number) % 5 < 3)
    return enrich.enrich_as_of(movements, taken).select("event_id", "branch", "company")


# Counters


@query
def route_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich.enrich(_movements(spark, sf_dir), _lookup(spark, sf_dir))
    routed = route.route(enriched, route.by_company("1"), 2)
    return routed.groupBy("route").agg(F.count("*").alias("n"))


@query
def stock_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.stock_movement(_movements(spark, sf_dir), _lookup(spark, sf_dir))


@query
def stock_movement_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken for a lookup that is too large to replicate."""
    large = lookup.Lookup.measure(_branches(spark, sf_dir), broadcast_limit=0)
    return counters.stock_movement(_movements(spark, sf_dir), large)


@query
def counter_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals folded from stored partials, one batch per line number."""
    lineitem = inputs.table(spark, sf_dir, "lineitem")
    batches = lineitem.select(
        F.col("l_linenumber").alias("batch_id"),
        F.col("l_suppkey").cast("string").alias("branch"),
        F.lit("").alias("company"),
        F.col("l_partkey").cast("string").alias("sku"),
        F.col("l_quantity").cast("bigint").alias("value"),
    )
    enriched = enrich.enrich(batches, _lookup(spark, sf_dir)).where("company = '1'")
    totals = store.PartialStore(spark, scratch_dir(spark, "counters"), store.STOCK_FAMILIES)
    totals.write("counters", counters.count_by_key(enriched, "batch_id").drop("batch_id"), "lines", 0)
    return totals.read("counters")


@query
def counter_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point reads from the stored counters: those of the hundred smallest keys that the lines would have if all were of company 1."""
    path = scratch_dir(spark, "counters")
    points.store_sorted(stock_movement(spark, sf_dir), path)
    line = F.concat(F.col("l_suppkey").cast("string"), F.lit("|1|"), F.col("l_partkey").cast("string")).alias("counter_key")
    asked = inputs.table(spark, sf_dir, "lineitem").select(line).distinct().orderBy("counter_key").limit(100)
    return points.read_keys(spark, path, [row["counter_key"] for row in asked.collect()])


# Minutes


@query
def minute_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    prefixes = {
        "visits_key": keys.VISITS_PREFIX,
        "users_key": keys.USERS_PREFIX,
        "experiments_key": keys.EXPERIMENTS_PREFIX,
    }
    made = [time.minute_key(prefix, "minute").alias(name) for name, prefix in prefixes.items()]
    return events.select("event_id", time.minute_floor("ts").alias("minute")).select("event_id", "minute", *made)


@query
def trailing_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = _events(spark, sf_dir).select(time.minute_floor("timestamp").alias("minute")).distinct()
    return minute.trailing_report(minutes.withColumn("metric", F.lit(0)), REPORT_MINUTES).select("timestamp")


@query
def nil_to_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counter text made from the events: absent, the text of an absent value, or a number."""
    kind = F.col("event_id") % 3
    text = F.when(kind == 1, keys.NIL).when(kind == 2, F.col("user_id").cast("string"))
    events = inputs.table(spark, sf_dir, "events")
    return events.select("event_id", keys.stored_int(text).alias("metric"))


@query
def visits_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = minute.minute_partials(_events(spark, sf_dir))
    return minute.trailing_report(minutes.select("minute", F.col("visits").alias("metric")), REPORT_MINUTES)


@query
def users_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = minute.minute_partials(_events(spark, sf_dir))
    users = F.hll_sketch_estimate("users").alias("metric")
    return minute.trailing_report(minutes.select("minute", users), REPORT_MINUTES)


@query
def experiments_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = minute.experiment_partials(_events(spark, sf_dir)).groupBy("minute")
    return minute.trailing_report(live.agg(F.count("experiment_id").alias("metric")), REPORT_MINUTES)


@query
def experiments_bitmap_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from bitmaps of four batches, folded."""
    batches = _events(spark, sf_dir).withColumn("batch_id", F.pmod(F.xxhash64("uid", "timestamp"), F.lit(4)))
    partials = minute.experiment_bitmaps(batches, "batch_id")
    return minute.trailing_report(minute.experiment_counts(minute.merge_experiments(partials)), REPORT_MINUTES)


@query
def users_per_day_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).withColumn("day", time.day_floor("timestamp"))
    return _with_error(events, "day")


def _with_error(events: DataFrame, by: str) -> DataFrame:
    both = minute.exact_users(events, by).join(minute.approximate_users(events, by), by)
    error = F.abs(F.col("approximate") - F.col("exact"))
    return both.select(by, "exact", (error <= F.col("exact") * 0.03).alias("within_3pct"))


@query
def users_approx_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of many users, with the order as the user: sketches are exact only for the smallest groups."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    return _with_error(lines.select(F.col("l_linestatus").alias("status"), F.col("l_orderkey").alias("uid")), "status")


@query
def metric_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute metrics folded from stored partials of four batches."""
    events = _events(spark, sf_dir)
    batches = events.withColumn("batch_id", F.pmod(F.xxhash64("uid", "timestamp"), F.lit(4)))
    saved = store.PartialStore(spark, scratch_dir(spark, "minutes"), store.WEB_FAMILIES)
    saved.write("minutes", minute.minute_partials(batches, "batch_id").drop("batch_id"), "quarters", 0)
    saved.write("experiments", minute.experiment_bitmaps(batches, "batch_id").drop("batch_id"), "quarters", 0)
    minutes = saved.read("minutes").withColumn("users", F.hll_sketch_estimate("users"))
    experiments = minute.experiment_counts(saved.read("experiments")).withColumnRenamed("metric", "n")
    return minutes.unpivot("minute", ["visits", "users"], "family", "n").unionByName(
        experiments.withColumn("family", F.lit("experiments"))
    )


@query
def fold_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits per minute from four batches of mixed days, with two compactions in between."""
    events = _events(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("timestamp"), F.lit(4)))
    saved = store.PartialStore(spark, scratch_dir(spark, "folds"), store.WEB_FAMILIES)
    for number in range(4):
        if number in (2, 3):
            saved.compact("quarters", number)
        part = events.where(F.col("part") == number)
        saved.write("minutes", minute.minute_partials(part), "quarters", number)
    return saved.read("minutes").select("minute", "visits")


# Variants


@query
def variant_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.merge_sets(_sets(spark, sf_dir))


@query
def variant_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next to the variant sets there are keys that only look like one."""
    orders = inputs.table(spark, sf_dir, "orders")
    others = orders.select(
        F.concat(F.lit("setXvar_"), "o_orderstatus").alias("set_key"), F.col("o_custkey").cast("string").alias("member")
    )
    return overlap.discover_variants(_sets(spark, sf_dir).unionByName(others))


@query
def variant_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.variant_pairs(overlap.discover_variants(_sets(spark, sf_dir)))


@query
def variant_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.variant_overlap(_sets(spark, sf_dir))


@query
def variant_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.intersect(_sets(spark, sf_dir), "1-URGENT", "5-LOW")


@query
def overlap_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored intersections, read back."""
    path = scratch_dir(spark, "overlap")
    overlap.store_overlap(overlap.overlap_members(_sets(spark, sf_dir)), path)
    return spark.read.schema("member STRING, overlap_key STRING").parquet(path)


@query
def overlap_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlap_dimensions(overlap.variant_pairs(overlap.discover_variants(_sets(spark, sf_dir))))


@query
def overlap_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output form of the overlap report, the pair as one array, shown as text."""
    points = overlap.with_dimensions(overlap.variant_overlap(_sets(spark, sf_dir)))
    return points.select(F.array_join("dimensions", "|").alias("dimensions"), "metric")


@query
def overlap_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _sets(spark, sf_dir)
    shown = [row["variant"] for row in overlap.discover_variants(sets).collect()]
    return overlap.overlap_matrix(overlap.variant_overlap(sets), shown)


@query
def variant_overlap_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps from one set sketch per variant, folded from those of three batches, against the exact ones."""
    batches = _sets(spark, sf_dir).withColumn("batch_id", F.pmod(F.xxhash64("member"), F.lit(3)))
    found = overlap.sketch_overlap(overlap.merge_sketches(overlap.set_sketches(batches, "batch_id")))
    exact = overlap.variant_overlap(_sets(spark, sf_dir))
    near = F.abs(F.col("approximate") - F.col("metric")) <= F.col("metric") * 0.05
    return exact.join(found, ["dim_a", "dim_b"]).select("dim_a", "dim_b", "metric", near.alias("within_5pct"))


@query
def conversion_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of each variant with a goal after their first event of the variant."""
    return overlap.ordered_conversion(_events(spark, sf_dir), GOAL)


@query
def experiment_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.experiment_conversion(_events(spark, sf_dir), GOAL)


# Streams


@query
def stream_stock_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship as a stream over the same messages."""
    root = scratch_dir(spark, "stock-stream")
    totals = store.PartialStore(spark, f"{root}/store", store.STOCK_FAMILIES)
    branches = lookup.RefreshingLookup(lambda: _branches(spark, sf_dir))
    changes = inputs.streamed_change_messages(spark, sf_dir)
    stock.start_stock_stream(
        changes, totals, branches, f"{root}/checkpoint", trigger=AVAILABLE_NOW
    ).awaitTermination()
    return totals.read("counters")


def _web_store(spark: SparkSession, sf_dir: str) -> store.PartialStore:
    """The web metrics of all events, through the stream."""
    root = scratch_dir(spark, "web-stream")
    saved = store.PartialStore(spark, f"{root}/store", store.WEB_FAMILIES)
    sent = inputs.streamed_visit_messages(spark, sf_dir)
    web.start_web_stream(sent, saved, f"{root}/checkpoint", trigger=AVAILABLE_NOW).awaitTermination()
    return saved


@query
def stream_visits_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    asof = time.latest_minute(_events(spark, sf_dir))
    return reports.visits(_web_store(spark, sf_dir), REPORT_MINUTES, asof)


@query
def stream_users_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    asof = time.latest_minute(_events(spark, sf_dir))
    return reports.users(_web_store(spark, sf_dir), REPORT_MINUTES, asof)


@query
def stream_experiments_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    asof = time.latest_minute(_events(spark, sf_dir))
    return reports.experiments(_web_store(spark, sf_dir), REPORT_MINUTES, asof)


@query
def stream_variant_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.variants_overlap(_web_store(spark, sf_dir))


@query
def stream_overlap_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of the orders' sets from what four batches change, folded; the report reads no set."""
    saved = store.PartialStore(spark, scratch_dir(spark, "overlap-store"), store.WEB_FAMILIES)
    batches = _sets(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("set_key", "member"), F.lit(4)))
    for number in range(4):
        sets = overlap.merge_sets(batches.where(F.col("part") == number))
        saved.write("overlap", overlap.overlap_delta(sets, saved.partials("variant_users")), "parts", number)
        saved.write("variant_users", sets, "parts", number)
    return reports.variants_overlap(saved)


# Bytes of a file of messages at most, about, so that no task writes or reads a whole delivery.
MESSAGE_FILE_BYTES = 128 << 20
# Those of a row group, at which files can be parted among tasks.
MESSAGE_GROUP_BYTES = 8 << 20


def _message_parts(rows: DataFrame, part: Column, share: int = 1) -> tuple[DataFrame, int]:
    """The messages, stored by the deliveries they come with, and the number of files that each delivery is made in.

    Of rows that take less than the messages made of them, a file has a ``share`` of the bytes. There are no more files than tasks that read a delivery.
    """
    spark = rows.sparkSession
    stored, path = materialize_at(rows.withColumn("part", part), "stream-input", "part", group_bytes=MESSAGE_GROUP_BYTES)
    folders = matching(spark, f"{path}/part=*")
    largest = max((folder_bytes(spark, folder) for folder in folders), default=0)
    pieces = max((spark.read.schema(rows.schema).parquet(folder).rdd.getNumPartitions() for folder in folders), default=0)
    return stored, max(1, min(pieces, -(-largest * share // MESSAGE_FILE_BYTES)))


def _message_files(stored: DataFrame, files: int, root: str, order: list[int]) -> None:
    """``files`` files of messages for each entry of ``order``, in this order of age: a stream that takes so many at once takes a delivery.

    Files without rows make up the number for a delivery that is stored in fewer pieces.
    """
    spark = stored.sparkSession
    for number in order:
        before = len(matching(spark, f"{root}/part-*"))
        sent = stored.where(F.col("part") == number).drop("part").coalesce(files)
        sent.write.mode("append").option("parquet.block.size", MESSAGE_GROUP_BYTES).parquet(root)
        for _ in range(before + files - len(matching(spark, f"{root}/part-*"))):
            spark.createDataFrame([], stored.drop("part").schema).write.mode("append").parquet(root)


@query
def stream_counters_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship with its running sums in the stream's own state: three batches, with a new start before the last."""
    root = scratch_dir(spark, "state-stream")
    kept = store.PartialStore(spark, f"{root}/store", state.STATE_FAMILIES)
    state.use_state_store(spark)
    lines = inputs.table(spark, sf_dir, "lineitem").select("l_linenumber", inputs.cdc_message().alias("value"))
    stored, files = _message_parts(lines, F.col("l_linenumber") % 3)
    for order in ([0, 1], [2]):
        _message_files(stored, files, f"{root}/in", order)
        changes = messages.stream_table(spark, f"{root}/in", max_files=files)
        state.start_counter_stream(
            changes, kept, _lookup(spark, sf_dir), f"{root}/checkpoint", trigger=AVAILABLE_NOW
        ).awaitTermination()
    return state.totals(kept)


@query
def stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship over a bus that delivers every message twice, the second time up to two minutes after.

    Deliveries are stored as the lines that the stream makes the messages of, which take a fraction of the room.
    """
    root = scratch_dir(spark, "redelivery-stream")
    totals = store.PartialStore(spark, f"{root}/store", store.STOCK_FAMILIES)
    state.use_state_store(spark)
    lines = inputs.table(spark, sf_dir, "lineitem")
    stored, files = _message_parts(lines, F.col("l_orderkey") % 3, share=8)
    _message_files(stored, files, f"{root}/in", [0, 1, 0, 2, 1, 2])
    delivered = messages.stream_table(spark, f"{root}/in", max_files=files)
    sent = inputs.bus_messages(inputs.spread(delivered, lines, *inputs.LINE))
    once = messages.drop_redelivered(sent, "message_id", "published_at", "10 minutes").select("value")
    branches = lookup.RefreshingLookup(lambda: _branches(spark, sf_dir))
    stock.start_stock_stream(once, totals, branches, f"{root}/checkpoint", trigger=AVAILABLE_NOW).awaitTermination()
    return totals.read("counters")


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three batches, of which a tenth come with the last: how many of each minute were on time, and how many late."""
    root = scratch_dir(spark, "late-stream")
    saved = store.PartialStore(spark, f"{root}/store", late.LATE_FAMILIES)
    events = inputs.table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("timestamp"))
    part = F.when(F.col("event_id") % 10 == 3, 2).when(F.col("timestamp") < F.lit("2024-01-16").cast("timestamp_ntz"), 0).otherwise(1)
    stored, files = _message_parts(events, part)
    _message_files(stored, files, f"{root}/in", [0, 1, 2])
    stream = messages.stream_table(spark, f"{root}/in", max_files=files)
    late.start_late_stream(stream, saved, f"{root}/checkpoint", timedelta(hours=1), trigger=AVAILABLE_NOW).awaitTermination()
    return late.visits_on_time_and_late(saved)


@query
def stream_visits_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visits report with the place of each point in it."""
    asof = time.latest_minute(_events(spark, sf_dir))
    report = reports.visits(_web_store(spark, sf_dir), REPORT_MINUTES, asof).coalesce(1)
    return report.select(F.monotonically_increasing_id().alias("place"), "timestamp", "metric")


@query
def stream_closed_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes that ended an hour before the newest event or earlier, however the events were cut into batches."""
    return reports.closed_minutes(_web_store(spark, sf_dir), minutes=60)


@query
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unusable messages in full, as the stream keeps them."""
    root = scratch_dir(spark, "reject-stream")
    totals = store.PartialStore(spark, f"{root}/store", store.STOCK_FAMILIES)
    sent = inputs.streamed_part_damaged_messages(spark, sf_dir)
    branches = lookup.RefreshingLookup(lambda: _branches(spark, sf_dir))
    stock.start_stock_stream(sent, totals, branches, f"{root}/checkpoint", trigger=AVAILABLE_NOW).awaitTermination()
    return totals.rejected_messages()


@query
def stream_lookup_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the stream over the same messages. The lookup has changed, and is read again, before the second."""
    root = scratch_dir(spark, "refresh-stream")
    hours = [0.0]

    def branches() -> DataFrame:
        moved = (F.col("company").cast("int") + (1 if hours[0] else 0)) % 3
        return _branches(spark, sf_dir).withColumn("company", moved.cast("string"))

    refreshing = lookup.RefreshingLookup(branches, clock=lambda: hours[0] * 3600)
    totals = store.PartialStore(spark, f"{root}/store", store.STOCK_FAMILIES)
    for run, hour in (("first", 0.0), ("same", 9.0), ("second", 10.0)):
        hours[0] = hour
        if run != "same":
            changes = inputs.streamed_change_messages(spark, sf_dir)
            stream = stock.start_stock_stream(changes, totals, refreshing, f"{root}/{run}", run=run, trigger=AVAILABLE_NOW)
            stream.awaitTermination()
        else:
            refreshing.get()  # too early for another read
    return totals.read("counters")
