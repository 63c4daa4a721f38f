"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

A source's words lie on a line in a seeded order of its documents, cut into equal blocks of ``block_words``. The words
of the mix are as many blocks, and every block is a seat that goes to the source with the highest quotient
target / (2 * seats so far + 1). Seats fall in a fixed order, so those of shard h of the mix are the next ones after shard h - 1 and
each shard gets whole quotas that follow the targets too. A shard takes its quota of a source's blocks where the shard before it has
stopped, the first one from a seeded start, and as often round the line as they reach: no block is taken again before all others
have been. ``shard_words`` tells what each shard takes of a document.

Scale. Words are counted in one narrow scan; after that only (source, id, size) is shuffled. A source's line is put
together from up to ``parts`` stretches of the seeded order, so a source with a third of all rows is spread
over as many groups; so are the texts of one repeated id, and equal rows are one row with a count until they have their places.
Per-source tables have one row per source; they are summed on the map side first and joined, not
collected. Which part of a document a mix takes follows from its place on the line by arithmetic: there is no table
of blocks or seats.

Defined results: a null text has size 0 and nothing is taken of it. A null source is a source of its own and comes last.
Equal seeded places are ordered by size, id and text digest; rows equal in all of them are interchangeable
and still take their places one after the other. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_PART = 1_000
CAP = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cap: int = CAP, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Words wanted of each source: ``source, source_size, target`` and its ``rank`` in code point order.

    Weights repeat over the sources in code point order, null last. A target stops at ``cap`` times the source's size and
    the rest is shared out again by weight until none is above its cap. That end state is a level: every source has
    min(cap * size, level * weight). Ordered by cap / weight, the level after the first k sources stop is what remains
    over the remaining weight, and the first k whose next source does not reach its cap is the answer.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    stops = ranked.withColumn("weight", weight.cast("double")).withColumn("most", F.lit(cap) * F.col("source_size"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = stops.withColumn("own_level", left / weight_left)
    open_level = F.when(F.col("most") >= F.col("own_level") * F.col("weight"), F.col("own_level"))
    level = F.max(open_level).over(everything)
    target = F.least(F.col("most").cast("double"), F.coalesce(level * F.col("weight"), F.lit(0.0)))
    return levels.withColumn("target", target).select("source", "source_size", "target", "rank")


def shard_quotas(targets: DataFrame, shards: int, block_words: int) -> DataFrame:
    """Whole blocks of each source in each shard by highest quotients: ``source, shard, quota``.

    Shard h holds the seats between h / shards and (h + 1) / shards of all. Seats are never taken back when there are more
    of them, so its quota is the difference of two apportionments.

    Only seats that can be won or lost are compared one by one. Rounding n shares moves the divisor by n / (2 * seats) of
    itself at most, so a quota lies within 2 + share * n / seats of the share; all nearer seats are won,
    all further ones lost. That leaves some seven rows per source and shard to order.
    """
    by_cut = Window.partitionBy("cut")
    n_seats = F.round(F.sum("target").over(by_cut) * F.col("cut") / shards / block_words).cast("long")
    cuts = targets.withColumn("cut", F.explode(F.sequence(F.lit(1), F.lit(shards)))).withColumn("seats", n_seats)
    share = F.col("target") * F.col("seats") / F.nullif(F.sum("target").over(by_cut), F.lit(0.0))
    cuts = cuts.withColumn("share", F.coalesce(share, F.lit(0.0)))
    spread = F.ceil(F.col("share") * F.count("*").over(by_cut) / F.greatest("seats", F.lit(1)))
    cuts = cuts.withColumn("near", F.least(spread + 2, F.col("seats") + 1))
    cuts = cuts.withColumn("won", F.greatest(F.floor("share") - F.col("near"), F.lit(0)))
    cuts = cuts.withColumn("left", F.col("seats") - F.sum("won").over(by_cut))
    tried = cuts.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), 2 * F.col("near") + 1)))
    tried = tried.withColumn("quotient", F.col("target") / (2 * (F.col("won") + F.col("step")) + 1))
    order = F.row_number().over(Window.partitionBy("cut").orderBy(F.desc("quotient"), "rank", "step"))
    taken = (F.col("order") <= F.col("left")) & (F.col("quotient") > 0)
    held = (
        tried.withColumn("order", order)
        .groupBy("rank", "cut")
        .agg(F.first("source").alias("source"), (F.first("won") + F.sum(taken.cast("long"))).alias("upto"))
    )
    earlier = F.coalesce(F.lag("upto").over(Window.partitionBy("rank").orderBy("cut")), F.lit(0))
    return held.select("source", (F.col("cut") - 1).alias("shard"), (F.col("upto") - earlier).alias("quota"))


def seeded(seed: int, *values: Column) -> Column:
    """28 bits that depend on the seed and the values, the same in every engine with MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(v.cast("string"), F.lit("-")) for v in values))
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def mix_sources(
    docs: DataFrame,
    seed: int = 7,
    block_words: int = 16,
    shards: int = 8,
    cap: int = CAP,
    weights: tuple[int, ...] = (1, 2, 3),
    parts: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """What the mix takes of each document: ``doc_id, digest, source, size, source_size, target, quota, taken, shard_words``.

    ``quota`` is the source's blocks in all shards, ``shard_words`` an array with the words that each shard takes, which add up to ``taken``.

    ``parts``: stretches of a source's line that are put in order separately; by default one for every
    ``ROWS_PER_PART`` rows of the table, up to a million.
    """
    sizes = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("digest"),
    )
    sizes = materialize(sizes.withColumn("place", seeded(seed, F.col("doc_id"), F.col("digest"))), "mix-sizes")
    if parts is None:
        parts = max(1, min(1 << 20, sizes.count() // ROWS_PER_PART))
    targets = source_targets(sizes, cap, weights)
    quotas = shard_quotas(targets, shards, block_words).groupBy("source")
    quotas = quotas.agg(F.sum("quota").alias("quota"), F.array_sort(F.collect_list(F.struct("shard", "quota"))).alias("of_shard"))
    same = F.col("t.source").eqNullSafe(F.col("n.source"))
    quotas = targets.alias("t").join(quotas.alias("n"), same).select("t.source", "source_size", "target", "quota", "of_shard")

    # Where each shard stops on the way round the line, in words; 0 first.
    def stop(shard: Column) -> Column:
        blocks = F.aggregate(F.slice("of_shard", F.lit(1), shard), F.lit(0).cast("long"), lambda s, q: s + q["quota"])
        return F.least(blocks * block_words, F.col("source_size") * cap)

    quotas = quotas.withColumn("stops", F.transform(F.sequence(F.lit(0), F.lit(shards)), stop)).drop("of_shard")

    # the seeded order, one stretch of it per group
    sizes = sizes.withColumn("part", F.floor(F.col("place") * parts / F.lit(1 << 28)).cast("int"))
    once = sizes.groupBy("source", "part", "place", "size", "doc_id", "digest").agg(F.count("*").alias("copies"))
    stretch = sizes.groupBy("source", "part").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretch = stretch.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0))).drop("words")
    same = F.col("s.source").eqNullSafe(F.col("q.source"))
    plan = stretch.alias("s").join(quotas.alias("q"), same).select("s.source", "part", "ahead", "source_size", "target", "quota", "stops")

    inside = Window.partitionBy("source", "part").orderBy("place", "size", "doc_id", "digest")
    words = F.col("size") * F.col("copies")
    placed = once.withColumn("end", F.sum(words).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("behind", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    placed = placed.withColumn("end", F.col("end") - F.col("behind") * F.col("size")).drop("behind", "copies")
    same = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.part") == F.col("p.part"))
    rows = placed.alias("d").join(plan.alias("p"), same).select("d.*", "ahead", "source_size", "target", "quota", "stops")
    taken = _taken_upto(seed, F.get("stops", F.lit(shards)))
    of_shards = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda h: _taken_upto(seed, F.get("stops", h + 1)) - _taken_upto(seed, F.get("stops", h)),
    )
    names = ["doc_id", "digest", "source", "size", "source_size", "target", "quota"]
    return rows.select(*names, taken.alias("taken"), of_shards.alias("shard_words"))


def _taken_upto(seed: int, wanted: Column) -> Column:
    """Of the first ``wanted`` words from the source's start on, round its line, those of a document at [ahead + end - size, ahead + end)."""
    high = F.col("ahead") + F.col("end")
    low = high - F.col("size")
    length = F.nullif(F.col("source_size"), F.lit(0))
    more = wanted % length
    start = seeded(seed, F.lit("start"), F.col("source")) % length

    def common(a: Column, b: Column) -> Column:
        return F.greatest(F.least(high, b) - F.greatest(low, a), F.lit(0))

    again = common(start, start + more) + common(F.lit(0), start + more - length)
    return F.when(F.col("size") == 0, F.lit(0)).otherwise(F.floor(wanted / length) * F.col("size") + again).cast("long")


def draw_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it, in whole documents.

    A document of which half the words or more are taken beyond whole passes is given once more. Rows equal in id and
    text share evenly what they are given together.
    """
    mix = mix_sources(docs, id_col=id_col, text_col=text_col, **options)
    name = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("-"))
    times = F.round(F.sum("taken") / F.nullif(F.sum("size"), F.lit(0))).cast("int")
    drawn = mix.groupBy(name.alias("name"), "digest").agg(times.alias("times")).where("times > 0")
    own = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("-"))
    digest = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(own.alias("name"), digest.alias("digest"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    repeated = rows.join(drawn, ["name", "digest"]).select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
    return repeated.select("row.*")
