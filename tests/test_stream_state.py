"""Keyed stream state: equal to the batch operators after every micro-batch and after a restart."""

import time

import pytest

from farpoint.operators import classes, sampling
from farpoint.streaming import (
    current_sample,
    histogram_so_far,
    largest_part_so_far,
    stream_class_histogram,
    stream_sample,
)
from farpoint.streaming.state import PROVIDER, ROCKSDB

POINTS = "id long, v array<double>"
RECORDS = "idx long, class string"


@pytest.fixture()
def stateful(spark):
    old = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set(PROVIDER, old)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def _write(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _run(build, spark, schema, tmp_path, name):
    """One run over whatever is new in the input folder; the next one goes on from its checkpoint."""
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = (build(stream).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", str(tmp_path / f"ck_{name}"))
         .option("path", str(tmp_path / name)).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(str(tmp_path / name))


def _points(lo, hi):
    return [(i, [float(i), float(i % 7)]) for i in range(lo, hi)]


@pytest.mark.parametrize("lanes", [1, 3])
def test_sample_equals_batch(stateful, tmp_path, lanes):
    spark, src = stateful, str(tmp_path / "in")
    # fewer rows than k, then many, then ids that came before
    for rows in (_points(0, 4), _points(4, 900), _points(800, 900) + _points(900, 1000)):
        _write(spark, rows, POINTS, src)
        out = _run(lambda s: stream_sample(s, 9, 5, lanes), spark, POINTS, tmp_path, "sample")
        got = [tuple(r) for r in current_sample(out, 9, 5).collect()]
        pts = spark.read.parquet(src).dropDuplicates(["id"])
        assert got == [tuple(r) for r in sampling.random_sample(pts, 9, 5).collect()]
    assert out.count() < 300                   # rows that entered, not all 1000


def test_histogram_equals_batch(stateful, tmp_path):
    spark, src = stateful, str(tmp_path / "in")
    hot = [(4 * i, "x") for i in range(500)]                     # one part, one class
    for rows in (hot, [(1, "y"), (5, "x"), (-1, "")], hot + [(3, "z")]):
        _write(spark, rows, RECORDS, src)
        out = _run(lambda s: stream_class_histogram(s, 4), spark, RECORDS, tmp_path, "hist")
        rec = spark.read.parquet(src)
        want = {tuple(r) for r in classes.class_histogram_by_part(rec, 4).collect()}
        assert {tuple(r) for r in histogram_so_far(out).collect()} == want
        assert (largest_part_so_far(out).first()
                == classes.max_partition_size_deterministic(rec, 4).first())


def test_histogram_by_timer(stateful, tmp_path):
    spark, src = stateful, str(tmp_path / "in")
    _write(spark, [(0, "x"), (4, "x"), (1, "y")], RECORDS, src)
    stream = spark.readStream.schema(RECORDS).parquet(src)
    q = (stream_class_histogram(stream, 4, every_ms=500).writeStream.outputMode("append")
         .format("memory").queryName("timed_hist")
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    try:
        end = time.time() + 60
        while time.time() < end and spark.table("timed_hist").count() < 2 and q.exception() is None:
            time.sleep(0.3)
        assert q.exception() is None
        got = {tuple(r) for r in spark.table("timed_hist").collect()}
    finally:
        q.stop()
    assert got == {(0, "x", 2, 2), (1, "y", 1, 1)}


def test_wrong_settings(spark):
    pts = spark.createDataFrame([], POINTS)
    with pytest.raises(ValueError):
        stream_sample(pts, 0, 1)
    with pytest.raises(ValueError, match="RocksDB"):
        stream_sample(pts, 3, 1)
    with pytest.raises(ValueError):
        stream_class_histogram(spark.createDataFrame([], RECORDS), 0)
