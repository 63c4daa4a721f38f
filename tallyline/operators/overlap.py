"""User sets of experiment variants and how they overlap.

A set is kept as rows ``set_key, member``; the operators do not mind a row that comes twice. Overlaps are
read off the combination of variants each member is in: members with the same combination are counted first,
and only the combinations are expanded to pairs. The rows are read and shuffled once. All pairs, zero included,
are the feature, so their number is that of the variants squared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.keys import is_variant_key, overlap_key, set_key, variant_name

# Side of the grid over which the pairs of variants are spread, and variants of a combination paired in one row.
PAIR_BLOCKS = 8
PAIR_SLICE = 64


def memberships(events: DataFrame) -> DataFrame:
    """One set row per event that has a user and a variant."""
    known = events.where(F.col("uid").isNotNull() & F.col("variant").isNotNull())
    return known.select(set_key("variant").alias("set_key"), F.col("uid").cast("string").alias("member"))


def variant_users(events: DataFrame) -> DataFrame:
    """Distinct users of each variant, over all time."""
    return memberships(events).distinct()


def merge_sets(sets: DataFrame) -> DataFrame:
    """Fold partial sets."""
    return sets.select("set_key", "member").distinct()


def discover_variants(sets: DataFrame) -> DataFrame:
    """Variants that have a user set, by key prefix."""
    keys = sets.select("set_key").distinct().where(is_variant_key(F.col("set_key")))
    return keys.select(variant_name(F.col("set_key")).alias("variant"))


def _combinations(sets: DataFrame) -> DataFrame:
    """The sorted variant sets each member is in."""
    return (
        sets.where(is_variant_key(F.col("set_key")))
        .groupBy("member")
        .agg(F.sort_array(F.collect_set("set_key")).alias("keys"))
    )


def _pairs_within(combinations: DataFrame, *keep: str) -> DataFrame:
    """Each two variants of a combination as ``dim_a, dim_b``, in sorted order.

    A combination is first cut into pairs of slices, rows of at most two slices of names. Those of a long one,
    say of a robot that is in every variant, are dealt out before they are expanded.
    """
    slices = F.ceil(F.size("keys") / PAIR_SLICE).cast("int")
    one = F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1)).alias("one")
    numbered = combinations.withColumn("slices", slices).select(*keep, "keys", "slices", one)
    two = F.explode(F.sequence("one", F.greatest(F.col("slices"), F.lit(1)) - 1)).alias("two")
    numbered = numbered.select(*keep, "keys", "slices", "one", two)

    def names(number: str) -> Column:
        return F.slice("keys", F.col(number) * PAIR_SLICE + 1, F.lit(PAIR_SLICE))

    cut = numbered.select(*keep, "slices", names("one").alias("left"), names("two").alias("right"))
    short, long = cut.where("slices <= 1"), cut.where("slices > 1")
    cut = short.unionByName(long.hint("rebalance"))
    firsts = cut.select(*keep, "right", F.explode("left").alias("first"))
    pairs = firsts.select(*keep, "first", F.explode("right").alias("second")).where("first < second")
    return pairs.select(
        variant_name(F.col("first")).alias("dim_a"), variant_name(F.col("second")).alias("dim_b"), *keep
    )


def variant_pairs(variants: DataFrame) -> DataFrame:
    """All unordered pairs of the distinct ``variant`` rows, smaller name first.

    Each variant is copied to one line and one column of a grid of blocks, and a pair meets in the block of
    its two hashes. That spreads the pairs over the cluster with an equi-join and no global numbering.
    """
    block = F.pmod(F.xxhash64("variant"), F.lit(PAIR_BLOCKS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(PAIR_BLOCKS - 1)))
    first = variants.select(F.col("variant").alias("dim_a"), block.alias("line"), every.alias("column"))
    second = variants.select(F.col("variant").alias("dim_b"), block.alias("column"), every.alias("line"))
    return (
        first.join(second, ["line", "column"])
        .where(F.col("dim_a") < F.col("dim_b"))
        .select("dim_a", "dim_b")
    )


def variant_overlap(sets: DataFrame) -> DataFrame:
    """Number of common users for every pair of variants, zero included.

    The names are read off the combinations too, so the sets are read once.
    """
    return combination_overlap(combination_counts(sets))


def combination_counts(sets: DataFrame) -> DataFrame:
    """Number of members in exactly the variants of each combination."""
    return _combinations(sets).groupBy("keys").agg(F.count("*").alias("users"))


def combination_overlap(combinations: DataFrame) -> DataFrame:
    """Number of common users for every pair of variants, from the counts of combinations."""
    common = _pairs_within(combinations, "users")
    names = combinations.select(F.explode("keys").alias("key")).distinct()
    none = variant_pairs(names.select(variant_name(F.col("key")).alias("variant")))
    none = none.withColumn("users", F.lit(0).cast("bigint"))
    return (
        common.unionByName(none)
        .groupBy("dim_a", "dim_b")
        .agg(F.sum("users").cast("double").alias("metric"))
    )


def overlap_delta(new: DataFrame, earlier: DataFrame) -> DataFrame:
    """What the set rows ``new`` change, as ``dim_a, dim_b, users``: common users of each pair of variants, and a variant with itself
    for the size of its set.

    A member's earlier combination of variants is taken back and its present one added. Members without a new variant change nothing.
    Of the ``earlier`` rows only those of members in ``new`` are shuffled.
    """
    new, earlier = (sets.where(is_variant_key(F.col("set_key"))) for sets in (new, earlier))
    known = earlier.join(new.select("member").distinct(), "member", "left_semi")
    both = new.select("set_key", "member", F.lit(True).alias("now")).unionByName(
        known.select("set_key", "member", F.lit(False).alias("now"))
    )
    per_member = both.groupBy("member").agg(
        F.sort_array(F.collect_set(F.when(~F.col("now"), F.col("set_key")))).alias("before"),
        F.sort_array(F.collect_set("set_key")).alias("after"),
    )
    changed = per_member.where(F.size("after") > F.size("before"))
    sides = [F.struct(F.col(c).alias("keys"), F.lit(n).alias("n")) for c, n in (("before", -1), ("after", 1))]
    sides = F.explode(F.array(*sides))
    combinations = changed.select(sides.alias("side")).groupBy("side.keys").agg(F.sum("side.n").alias("users")).where("users <> 0")
    own = combinations.select(F.explode("keys").alias("key"), "users").withColumn("name", variant_name(F.col("key")))
    own = own.select(F.col("name").alias("dim_a"), F.col("name").alias("dim_b"), "users")
    return merge_overlap(_pairs_within(combinations, "users").unionByName(own))


def merge_overlap(partials: DataFrame) -> DataFrame:
    """Fold what batches changed: at most a row per pair of variants."""
    return partials.groupBy("dim_a", "dim_b").agg(F.sum("users").alias("users"))


def folded_overlap(folded: DataFrame) -> DataFrame:
    """Number of common users for every pair of variants, zero included, from folded changes and without the sets."""
    names = folded.where(F.col("dim_a") == F.col("dim_b")).select(F.col("dim_a").alias("variant"))
    none = variant_pairs(names).withColumn("users", F.lit(0).cast("bigint"))
    common = folded.where(F.col("dim_a") < F.col("dim_b")).select("dim_a", "dim_b", "users")
    pairs = common.unionByName(none).groupBy("dim_a", "dim_b")
    return pairs.agg(F.sum("users").cast("double").alias("metric"))


# Size of a set sketch, as a power of two: sets up to that many members are counted exactly.
THETA_BITS = 14


def set_sketches(sets: DataFrame, *by: str) -> DataFrame:
    """One mergeable sketch per variant, of a bounded size whatever its members; ``by`` keeps batches apart."""
    named = sets.where(is_variant_key(F.col("set_key")))
    sketch = F.theta_sketch_agg("member", THETA_BITS).alias("sketch")
    return named.groupBy(*by, variant_name(F.col("set_key")).alias("variant")).agg(sketch)


def merge_sketches(partials: DataFrame) -> DataFrame:
    """Fold sketches to one per variant."""
    return partials.groupBy("variant").agg(F.theta_union_agg("sketch", THETA_BITS).alias("sketch"))


def sketch_overlap(sketches: DataFrame) -> DataFrame:
    """Approximate number of common users for every pair of variants, from one sketch per variant and without the sets."""
    first = sketches.select(F.col("variant").alias("dim_a"), F.col("sketch").alias("one"))
    second = sketches.select(F.col("variant").alias("dim_b"), F.col("sketch").alias("two"))
    both = variant_pairs(sketches.select("variant")).join(first, "dim_a").join(second, "dim_b")
    return both.select("dim_a", "dim_b", F.theta_sketch_estimate(F.theta_intersection("one", "two")).alias("approximate"))


def overlap_members(sets: DataFrame) -> DataFrame:
    """Members of the intersection of every pair of variants."""
    pairs = _pairs_within(_combinations(sets), "member")
    return pairs.select(overlap_key(set_key("dim_a"), set_key("dim_b")).alias("overlap_key"), "member")


def store_overlap(members: DataFrame, path: str) -> None:
    """Write the intersections under their names; each run replaces the one before.

    The rebalance gathers a small intersection in one file and splits a large one over many.
    """
    gathered = members.hint("rebalance", F.col("overlap_key"))
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("overlap_key").parquet(path)


def intersect(sets: DataFrame, first: str, second: str) -> DataFrame:
    """Members common to two sets, by variant name."""
    one, two = (
        sets.where(F.col("set_key") == set_key(F.lit(name))).select("member") for name in (first, second)
    )
    return one.intersect(two)


def overlap_dimensions(overlap: DataFrame) -> DataFrame:
    """Every variant that occurs in a pair."""
    both = F.explode(F.array("dim_a", "dim_b")).alias("dimension")
    return overlap.select(both).distinct()


def overlap_matrix(overlap: DataFrame, columns: list[str]) -> DataFrame:
    """One row per first variant, one column for each named variant, null where the pair does not exist.

    This is how a few variants are shown. ``variant_overlap`` is the same in long form, for any number of them.
    """
    return overlap.groupBy(F.col("dim_a").alias("variant")).pivot("dim_b", sorted(columns)).agg(F.first("metric"))


def with_dimensions(overlap: DataFrame) -> DataFrame:
    """The pair as one array, the output form of a report."""
    return overlap.select(F.array("dim_a", "dim_b").alias("dimensions"), "metric").distinct()


def ordered_conversion(events: DataFrame, goal: str) -> DataFrame:
    """Users of each variant of an experiment, and how many had a ``goal`` event of the experiment after their first event of the variant.

    Rows ``experiment_id, variant, users, converted, rate``. A goal before the exposure, or at the same time, does not count. Events without
    a user are nobody's. A user's events are reduced to one row per variant before the goal is matched, so no user is a heavy group.
    """
    known = events.where(F.col("uid").isNotNull() & F.col("variant").isNotNull())
    per_variant = known.groupBy("experiment_id", "uid", "variant").agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )
    of_user = Window.partitionBy("experiment_id", "uid")
    reached = F.max(F.when(F.col("variant") == goal, F.col("last"))).over(of_user)
    exposed = per_variant.withColumn("reached", reached).where(F.col("variant") != goal)
    return (
        exposed.groupBy("experiment_id", "variant")
        .agg(F.count("*").alias("users"), F.count_if(F.col("reached") > F.col("first")).alias("converted"))
        .withColumn("rate", F.try_divide("converted", "users"))
    )


def experiment_conversion(events: DataFrame, goal: str) -> DataFrame:
    """Share of an experiment's users with at least one ``goal`` event.

    An event without a user is nobody's; an experiment that only has such events has no users and no rate.
    """
    per_user = events.groupBy("experiment_id", "uid").agg(F.max(F.col("variant") == goal).alias("converted"))
    known = F.col("uid").isNotNull()
    return (
        per_user.groupBy("experiment_id")
        .agg(F.count_if(known).alias("users"), F.count_if(known & F.col("converted")).alias("converted"))
        .withColumn("rate", F.try_divide("converted", "users"))
    )
