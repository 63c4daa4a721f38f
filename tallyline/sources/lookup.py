"""The slowly changing branch lookup: scan, checks, size and periodic re-read."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import materialize, scratch_dir

# Largest lookup that is replicated to every executor, counted on its rows and not guessed from files.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64

# Fixed value: seconds between two reads of the lookup.
REFRESH_SECONDS = 10 * 60 * 60


class DuplicateKeyError(ValueError):
    """The lookup has several rows for one key."""


def scan_lookup(table: DataFrame, key: str = "branch_id", value: str = "cpy_id") -> DataFrame:
    """The two lookup columns as text. Rows with a null in either cannot be looked up and are left out."""
    return table.select(
        F.col(key).cast("string").alias("branch"), F.col(value).cast("string").alias("company")
    ).where(F.col("branch").isNotNull() & F.col("company").isNotNull())


def query_lookup(spark: SparkSession, sql: str, key: str = "branch_id", value: str = "cpy_id") -> DataFrame:
    """The lookup from a query of the session's tables. A warehouse table is one read with ``spark.read.jdbc``."""
    return scan_lookup(spark.sql(sql), key, value)


def unusable_rows(table: DataFrame, key: str = "branch_id", value: str = "cpy_id") -> DataFrame:
    """Number of lookup rows left out for a null key and for a null value."""
    return table.agg(
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_if(F.col(key).isNotNull() & F.col(value).isNull()).alias("null_values"),
    )


def lookup_duplicates(lookup: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys with more than one row; empty for a usable lookup."""
    return lookup.groupBy(*(keys or ["branch"])).agg(F.count("*").alias("n")).where("n > 1")


@dataclass(frozen=True)
class Lookup:
    """A checked lookup with its measured size."""

    rows: DataFrame
    n_rows: int
    n_bytes: int
    broadcast_limit: int = BROADCAST_BYTES

    @property
    def fits_broadcast(self) -> bool:
        return self.n_bytes <= self.broadcast_limit

    @classmethod
    def measure(
        cls, rows: DataFrame, keys: list[str] | None = None, broadcast_limit: int = BROADCAST_BYTES
    ) -> Lookup:
        """Count the rows and their size, and fail at once if a key is not unique.

        One job with a map-side aggregate; a single row of totals reaches the driver.
        """
        width = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in rows.columns)
        totals = (
            rows.withColumn("_width", width)
            .groupBy(*(keys or ["branch"]))
            .agg(F.count("*").alias("n"), F.sum("_width").alias("width"))
            .agg(F.sum("n").alias("rows"), F.max("n").alias("most"), F.sum("width").alias("width"))
            .first()
        )
        if (totals["most"] or 0) > 1:
            raise DuplicateKeyError(f"lookup key {keys or ['branch']} has up to {totals['most']} rows")
        n_rows = totals["rows"] or 0
        return cls(rows, n_rows, (totals["width"] or 0) + ROW_OVERHEAD_BYTES * n_rows, broadcast_limit)


def store_bucketed(lookup: Lookup, table: str, buckets: int | None = None) -> Lookup:
    """Write the lookup as a table bucketed and sorted by branch, for joins that shuffle only the movements.

    As many buckets as shuffles have partitions, unless told otherwise: with fewer, Spark would deal the lookup out anew for
    more tasks. The table stays until it is dropped, and serves every batch until the lookup changes.
    """
    spark = lookup.rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, table)
    dealt = lookup.rows.repartition(buckets, "branch")  # a file per bucket, and not one per bucket and task
    dealt.write.bucketBy(buckets, "branch").sortBy("branch").option("path", path).mode("overwrite").saveAsTable(table)
    return Lookup(spark.table(table), lookup.n_rows, lookup.n_bytes, lookup.broadcast_limit)


class RefreshingLookup:
    """Re-reads the lookup once it is older than ``ttl`` seconds.

    A DataFrame keeps the file list of the moment it was made, so a long-running stream that held on to one
    would never see a change. ``read`` makes a new one. What it gives is copied to the shared folder, so that
    every batch until the next read sees the same lookup, whatever happens to the source or to an executor.
    """

    def __init__(
        self,
        read: Callable[[], DataFrame],
        ttl: float = REFRESH_SECONDS,
        clock: Callable[[], float] = time.monotonic,
    ):
        self._read = read
        self._ttl = ttl
        self._clock = clock
        self._current: Lookup | None = None
        self._read_at = 0.0

    def get(self) -> Lookup:
        now = self._clock()
        if self._current is None or now - self._read_at >= self._ttl:
            self._current = Lookup.measure(materialize(self._read(), "lookup"))
            self._read_at = now
        return self._current
