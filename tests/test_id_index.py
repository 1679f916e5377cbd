"""The index of stored ids: no id lost or kept twice, and only the buckets asked for are read."""

import pytest
from pyspark.sql import functions as F

from hirelens.session import scratch_path
from hirelens.sources import id_index, table_log


def numbers(spark, first, last):
    return spark.range(first, last).select(F.col("id").cast("string").alias("id"))


def test_loads_keep_every_new_id_once_and_no_known_one(spark):
    path = scratch_path(spark, "index")
    id_index.create(spark, path, 9000, buckets=8)
    assert id_index.unseen(numbers(spark, 0, 5), "id", path).count() == 5
    id_index.extend(numbers(spark, 0, 5000), "id", path)
    id_index.extend(numbers(spark, 4000, 9000), "id", path)
    left = {int(r.id) for r in id_index.unseen(numbers(spark, 0, 12000), "id", path).collect()}
    assert left == set(range(9000, 12000))
    id_index.compact(spark, path)
    assert {int(r.id) for r in id_index.unseen(numbers(spark, 8990, 9010), "id", path).collect()} == set(range(9000, 9010))
    assert len(table_log.entry(spark, f"{path}/ids", table_log.versions(spark, f"{path}/ids")[-1])["parts"]) == 8


def test_an_overfull_filter_loses_nothing(spark):
    path = scratch_path(spark, "index")
    id_index.create(spark, path, 0, buckets=1)
    id_index.extend(numbers(spark, 0, 60000), "id", path)
    left = {int(r.id) for r in id_index.unseen(numbers(spark, 59000, 61000), "id", path).collect()}
    assert left == set(range(60000, 61000))


def test_a_load_reads_only_buckets_that_may_have_its_ids(spark):
    path = scratch_path(spark, "index")
    id_index.create(spark, path, 20000)
    id_index.extend(numbers(spark, 0, 20000), "id", path)
    found = id_index.candidates(numbers(spark, 20000, 22000), "id", path)
    assert len(id_index.touched(found)) == 0
    again = id_index.touched(id_index.candidates(numbers(spark, 19997, 22000), "id", path))
    assert 1 <= len(again) <= 3
    read = id_index._stored(spark, path, again)
    assert {"19997", "19998", "19999"} <= {r.id for r in read.collect()}
    assert len({f.rsplit("/", 2)[1] for f in read.inputFiles()}) == len(again)


def test_odd_ids_clashing_names_and_empty_tables(spark):
    path = scratch_path(spark, "index")
    id_index.create(spark, path, 20000)
    rows = spark.createDataFrame([(None, 1, b"x"), ("", 2, None), ("a", 3, None), ("a", 3, None), ("é" * 9000, 4, None)], "ID string, bucket int, bits binary")
    id_index.extend(rows.where("false"), "ID", path)
    id_index.extend(rows.where("bucket = 4"), "ID", path)
    got = id_index.unseen(rows, "ID", path)
    assert got.columns == ["ID", "bucket", "bits"] and sorted(r.bucket for r in got.collect()) == [1, 2, 3, 3]
    assert sorted(r.bucket for r in id_index.unseen(rows, "ID", path, keep_null_ids=False).collect()) == [3, 3]
    assert id_index.unseen(rows.where("false"), "ID", path).count() == 0


def test_a_load_that_fails_halfway_loses_no_id(spark, monkeypatch):
    path = scratch_path(spark, "index")
    id_index.create(spark, path, 20000)

    def fails(*args, **kwargs):
        raise OSError("no room")

    with monkeypatch.context() as m:
        m.setattr(table_log, "append", fails)
        with pytest.raises(OSError):
            id_index.extend(numbers(spark, 0, 50), "id", path)
    assert id_index.unseen(numbers(spark, 0, 50), "id", path).count() == 50
    id_index.extend(numbers(spark, 0, 50), "id", path)
    assert id_index.unseen(numbers(spark, 0, 51), "id", path).count() == 1
