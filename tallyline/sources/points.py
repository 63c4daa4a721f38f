"""Point reads of stored counters: a few keys out of very many, without a scan of all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys in one request. They become a filter, not a table, so that they reach the files; longer lists are joins.
MOST_KEYS = 1_000
#: Distinct keys that the filter of a row group is made for.
FILTER_KEYS = 1_000_000


def store_sorted(counters: DataFrame, path: str, key: str = "counter_key") -> None:
    """Write the counters in ranges of the key, sorted, with a Bloom filter of the key per row group.

    A read of one key opens the row groups whose range holds it, at most one of each file, and of those the ones whose filter knows it.
    """
    ordered = counters.repartitionByRange(key).sortWithinPartitions(key)
    writer = ordered.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(FILTER_KEYS)).parquet(path)


def read_keys(spark: SparkSession, path: str, keys: list[str], key: str = "counter_key", value: str = "total") -> DataFrame:
    """``place, key, value`` of each wanted key in the order of the request, 0 for one that is not stored.

    Repeated keys are answered each. A request has at most ``MOST_KEYS``.
    """
    if len(keys) > MOST_KEYS:
        raise ValueError(f"{len(keys)} keys in one request; at most {MOST_KEYS}")
    asked = spark.createDataFrame(list(enumerate(keys)), f"place INT, {key} STRING")
    stored = spark.read.parquet(path).where(F.col(key).isin(sorted(set(keys)))).select(key, value)
    found = asked.join(F.broadcast(stored), key, "left")  # a stored key has one row, so at most MOST_KEYS
    return found.select("place", key, F.coalesce(value, F.lit(0)).alias(value)).orderBy("place")
