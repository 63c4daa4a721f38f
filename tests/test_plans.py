"""The physical plans that matter at scale."""

from __future__ import annotations

from datetime import datetime

import pytest

import __spark_entry__ as contract
from tallyline.functions.time import within_trailing
from tallyline.operators.minute import minute_partials
from tallyline.plans.catalog import QUERIES
from tallyline.plans.inputs import web_events
from tallyline.session import release, scratch_dir, shared_dir


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


def test_flagship(spark, sf_dir):
    text = plan(contract.queries()["stock_movement"](spark, sf_dir))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert text.count("from_json") == 1, "each message is parsed once"
    assert "partial_try_sum" in text
    assert "l_extendedprice" not in text


def test_shuffled_flagship_sums_before_the_join(spark, sf_dir):
    text = plan(contract.queries()["stock_movement_shuffled"](spark, sf_dir))
    assert "SortMergeJoin" in text
    assert text.index("SortMergeJoin") < text.index("partial_try_sum")


def test_shuffled_enrichment_is_shuffled(spark, sf_dir):
    text = plan(contract.queries()["enrich_company_shuffled"](spark, sf_dir))
    assert "SortMergeJoin" in text


@pytest.mark.parametrize("name", ["trailing_spine", "visits_per_minute", "users_per_minute", "experiments_per_minute"])
def test_minute_reports_read_the_events_once_and_only_when_run(spark, sf_dir, name):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build {name}", "")
    frame = QUERIES[name](spark, sf_dir)
    ran = [j for j in jobs.getJobIdsForGroup(f"build {name}")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(ran) <= 1  # reading the schema of the table
    assert plan(frame).count("Scan parquet") == 2  # once in the tree, once in the details


def test_time_range_reaches_the_scan(spark, sf_dir):
    events = web_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    text = plan(minute_partials(within_trailing(events, 60, datetime(2024, 1, 1, 5))))
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text


def test_scans_are_pruned(spark, sf_dir):
    text = plan(contract.queries()["visits_per_minute"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text
    text = plan(contract.queries()["variant_overlap"](spark, sf_dir))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in text


def test_scratch_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(shared) and one != two


class Settings:
    """A session with these settings only."""

    def __init__(self, **values):
        self.conf, self._values = self, {name.replace("_", "."): value for name, value in values.items()}

    def get(self, name, default=None):
        return self._values.get(name.replace("_", "."), default)


def test_folder_below_the_warehouse():
    assert shared_dir(Settings(spark_sql_warehouse_dir="hdfs://w/")) == "hdfs://w/_scratch"
    assert shared_dir(Settings(spark_checkpoint_dir="hdfs://c", spark_master="yarn")) == "hdfs://c"
    assert shared_dir(Settings(spark_checkpoint_dir="file:/c", spark_master="local-cluster[3,2,1]")) == "file:/c"
    with pytest.raises(ValueError):
        shared_dir(Settings(spark_checkpoint_dir="file:/c", spark_master="yarn"))


def test_work_folders_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyline.session.shared_dir", lambda _: str(tmp_path))
    spark.range(3).write.parquet(scratch_dir(spark, "x"))
    assert any(tmp_path.iterdir())
    release(spark)
    assert not any(tmp_path.iterdir())
