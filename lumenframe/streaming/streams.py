"""Stream forms of the bucket, cleaning, scoring and flattening operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.functions.scalars import safe_int
from lumenframe.operators.linear import linear_score
from lumenframe.sources.nested import flatten_threads
from lumenframe.sources.scratch import fresh_path


def parquet_stream(spark: SparkSession, folder: str, pattern: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def run_available(stream: DataFrame, tag: str) -> DataFrame:
    """Run a stream over everything there is, into Parquet files in the shared folder, and read them back."""
    spark = stream.sparkSession
    path = fresh_path(spark, tag)
    running = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}-progress")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def bucket_values(
    stream: DataFrame, time: str, keys: Sequence[str], tie: str, value: str, bucket: str, late: str
) -> DataFrame:
    """``start, keys, first, last, mean, cnt`` per closed bucket; rows later than ``late`` are dropped."""
    rows = stream.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", late)
    order = F.struct(time, tie)
    sums = rows.groupBy(F.window("_time", bucket).alias("_w"), *keys).agg(
        F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"),
        F.avg(value).alias("mean"), F.count(value).alias("cnt"),
    )
    return sums.select(F.col("_w.start").cast("timestamp_ntz").alias("start"), *keys, "first", "last", "mean", "cnt")


def clean_records(stream: DataFrame, key: str, props: str, field: str, valid: Column) -> DataFrame:
    """Stateless: a number out of a JSON text (-1 if there is none) and a validity flag."""
    number = safe_int(F.get_json_object(props, f"$.{field}"), -1)
    return stream.select(key, number.alias(field), valid.alias("valid"))


def validity_per_bucket(stream: DataFrame, time: str, valid: Column, bucket: str, late: str) -> DataFrame:
    """``start, valid_cnt, corrupted_cnt`` per closed bucket."""
    rows = stream.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", late)
    sums = rows.groupBy(F.window("_time", bucket).alias("_w")).agg(
        F.count_if(valid).alias("valid_cnt"), F.count_if(~valid).alias("corrupted_cnt")
    )
    return sums.select(F.col("_w.start").cast("timestamp_ntz").alias("start"), "valid_cnt", "corrupted_cnt")


def score_linear(stream: DataFrame, coef: Mapping[str, float], keep: Sequence[str], out: str = "score") -> DataFrame:
    """Score with a model fitted on a table beforehand."""
    return stream.select(*keep, linear_score(dict(coef)).alias(out))


def flatten_pages(stream: DataFrame, payload: str, identity: Sequence[str], late: str) -> DataFrame:
    """Comments of the incoming pages; a comment seen again within ``late`` is dropped.

    The state of a comment is 128 bits of its identity's hash and the time at which it is forgotten, whatever the comment's length.
    A null in the identity is a value like others.
    """
    rows = flatten_threads(stream, payload).withColumn("_time", F.to_timestamp("time"))
    whole = F.to_json(F.struct(*identity), {"ignoreNullFields": "false"})
    rows = rows.withColumns({"_h1": F.xxhash64(whole), "_h2": F.xxhash64(F.lit(1), whole)})
    unique = rows.withWatermark("_time", late).dropDuplicatesWithinWatermark(["_h1", "_h2"])
    return unique.drop("_time", "_h1", "_h2")
