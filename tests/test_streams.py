"""Stream forms over several files, with late and repeated rows."""

from __future__ import annotations

import datetime
import os
import time

from pyspark.sql import functions as F

from lumenframe.sources import scratch
from lumenframe.streaming import streams as X

SCHEMA = "event_id long, ts timestamp_ntz, kind string, value double"


def ts(hour, minute=0):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hour, minutes=minute)


def write(spark, path, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/{name}")


def test_buckets_drop_late_rows(spark, tmp_path):
    """Files arrive one per batch; a row behind the watermark is dropped, an open bucket is not shown."""
    for i, rows in enumerate(
        (
            [(1, ts(0, 5), "a", 1.0), (2, ts(0, 50), "a", 3.0)],
            [(3, ts(5), "a", 9.0)],
            [(7, ts(5, 10), "a", 10.0)],
            [(4, ts(0, 10), "a", 100.0), (5, ts(5, 30), "a", 11.0)],
            [(6, ts(9), "a", 0.0)],
        )
    ):
        write(spark, str(tmp_path), rows, f"part{i}")
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(5):
        source = next((tmp_path / f"part{i}").glob("*.parquet"))
        target = folder / f"{i}.parquet"
        target.write_bytes(source.read_bytes())
        os.utime(target, (time.time() - 100 + i, time.time() - 100 + i))
    stream = X.parquet_stream(spark, str(folder), "*.parquet", SCHEMA, files_per_trigger=1)
    out = X.run_available(X.bucket_values(stream, "ts", ["kind"], "event_id", "value", "1 hour", "1 hour"), "test")
    got = [tuple(r) for r in out.orderBy("start").collect()]
    assert got == [(ts(0), "a", 1.0, 3.0, 2.0, 2), (ts(5), "a", 9.0, 11.0, 10.0, 3)]


def test_score_and_clean(spark, tmp_path):
    rows = spark.createDataFrame([(1, '{"k": 4}'), (2, '{"k": "x"}'), (3, "{}")], "id long, props string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    cleaned = X.run_available(X.clean_records(stream, "id", "props", "k", F.col("id") != 2), "test")
    assert [tuple(r) for r in cleaned.orderBy("id").collect()] == [(1, 4, True), (2, -1, False), (3, -1, True)]


def test_materialize_and_release(spark):
    df = scratch.materialize(spark.range(100).withColumn("x", F.rand()))
    assert df.orderBy("id").collect() == df.orderBy("id").collect()
    files = df.inputFiles()
    scratch.release(df)
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
