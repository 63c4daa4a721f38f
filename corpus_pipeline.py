"""From raw documents to training shards: filter, de-duplicate, decontaminate, mix, shard.

Each stage is a function of (spark, docs, sf_dir). Its result is written to the folder that the cluster shares and read
again as the next one's documents, so a stage that is lost is repeated from its predecessor's files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import decontamination, jaccard, mixing, quality, sharding
from tallyline.session import materialize


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the Jaccard join connects."""
    return jaccard.keep_one_per_class(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_leaked(docs, decontamination.find_leaks(docs, benchmark, shortest=1))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a repeated document is a repeated row."""
    return mixing.draw_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``shard`` and ``slot``; a column of the input with such a name is replaced."""
    placed = sharding.shard_documents(docs)
    kept = [f"row.`{c}`" for c in docs.columns if c not in ("shard", "slot")]
    return placed.select(*kept, "shard", "slot")


STAGES = [
    ("quality", filter_quality),
    ("near_duplicates", remove_near_copies),
    ("decontamination", remove_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

#: Digests that DuckDB lacks order the shards, so the rows are tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
