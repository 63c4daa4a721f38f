from __future__ import annotations

import pytest

from tallyline.sources.lookup import (
    DuplicateKeyError,
    Lookup,
    RefreshingLookup,
    lookup_duplicates,
    query_lookup,
    scan_lookup,
    unusable_rows,
)

TABLE = "branch_id INT, cpy_id STRING, other STRING"


def test_scan_leaves_out_nulls(spark):
    table = spark.createDataFrame([(1, "1", "x"), (None, "2", "x"), (3, None, "x")], TABLE)
    assert [tuple(r) for r in scan_lookup(table).collect()] == [("1", "1")]
    assert tuple(unusable_rows(table).first()) == (1, 1)


def test_scan_reads_two_columns(spark, tmp_path):
    spark.createDataFrame([(1, "1", "x")], TABLE).write.parquet(str(tmp_path / "t"))
    plan = scan_lookup(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<branch_id:int,cpy_id:string>" in plan


def test_lookup_from_a_query(spark):
    spark.createDataFrame([(1, "1", "x"), (2, "2", "x")], TABLE).createOrReplaceTempView("branch_table")
    found = query_lookup(spark, "SELECT branch_id, cpy_id FROM branch_table")
    assert sorted(map(tuple, found.collect())) == [("1", "1"), ("2", "2")]


def test_duplicates_are_reported_and_refused(spark):
    rows = spark.createDataFrame([("1", "1"), ("1", "2"), ("2", "1")], "branch STRING, company STRING")
    assert [tuple(r) for r in lookup_duplicates(rows).collect()] == [("1", 2)]
    with pytest.raises(DuplicateKeyError):
        Lookup.measure(rows)


def test_size_is_measured(spark):
    rows = spark.range(1000).selectExpr("CAST(id AS STRING) AS branch", "repeat('x', 100) AS company")
    measured = Lookup.measure(rows)
    assert measured.n_rows == 1000
    assert 100_000 < measured.n_bytes < 200_000
    assert measured.fits_broadcast
    assert not Lookup.measure(rows, broadcast_limit=100_000).fits_broadcast


def test_empty_lookup(spark):
    empty = Lookup.measure(spark.createDataFrame([], "branch STRING, company STRING"))
    assert (empty.n_rows, empty.n_bytes) == (0, 0)


def test_refresh_sees_new_files_after_the_ttl(spark, tmp_path):
    path = str(tmp_path / "lookup")
    add = lambda branch: spark.createDataFrame([(branch, "1", "x")], TABLE).write.mode("append").parquet(path)
    add(1)
    now = [0.0]
    lookup = RefreshingLookup(lambda: scan_lookup(spark.read.parquet(path)), ttl=10, clock=lambda: now[0])
    assert lookup.get().n_rows == 1
    add(2)
    now[0] = 9.9
    assert lookup.get().n_rows == 1
    now[0] = 10.0
    assert lookup.get().n_rows == 2
    assert lookup.get().rows.count() == 2


def test_lookup_stays_the_same_until_the_next_read(spark, tmp_path):
    path = str(tmp_path / "lookup")
    spark.createDataFrame([(1, "1", "x")], TABLE).write.parquet(path)
    lookup = RefreshingLookup(lambda: scan_lookup(spark.read.parquet(path)), ttl=10, clock=lambda: 0.0)
    lookup.get()
    spark.createDataFrame([(2, "2", "x")], TABLE).write.mode("overwrite").parquet(path)
    assert [tuple(r) for r in lookup.get().rows.collect()] == [("1", "1")]
