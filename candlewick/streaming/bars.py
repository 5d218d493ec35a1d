"""L1: ticks -> 60-minute bars, in batch and as a Structured Streaming query.

The stream keeps no state: each micro-batch lands the partial bars of its ticks (sum, count, extremes
with their times) in its own ``batch_id=N`` folder, overwritten if the batch is replayed after a failure,
and the read side merges the partial bars of each (market, hour). A tick of any age is counted, in any
order of arrival, so stream and batch agree without a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.sources.fixtures import hourly_ticks

BAR_KEYS = ["market_id", "ds"]


def bar_aggregates():
    return [
        F.min_by("px", "ts").alias("open"), F.max("px").alias("high"), F.min("px").alias("low"),
        F.max_by("px", "ts").alias("close"), F.avg("px").alias("mean_px"), F.sum("value").alias("volume"),
        F.count(F.lit(1)).alias("n_ticks"),
    ]


def hourly_bars(events: DataFrame) -> DataFrame:
    """Batch bars keyed by (market_id, hour start)."""
    t = hourly_ticks(events).withColumn("ts", F.col("ts").cast("timestamp"))
    w = F.window("ts", "60 minutes")
    return t.groupBy("market_id", w.alias("w")).agg(*bar_aggregates()) \
        .select("market_id", F.col("w.start").alias("ds"), "open", "high", "low", "close", "mean_px", "volume", "n_ticks")


def file_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet", schema=None) -> DataFrame:
    """Parquet files of ``folder`` matching ``pattern`` as a stream (explicit schema)."""
    schema = schema or spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def partial_bars(ticks: DataFrame) -> DataFrame:
    """Mergeable partial bars of one micro-batch: fixed-width, combined map-side."""
    t = hourly_ticks(ticks).withColumn("ts", F.col("ts").cast("timestamp"))
    w = F.window("ts", "60 minutes")
    return t.groupBy("market_id", w.alias("w")).agg(
        F.min_by("px", "ts").alias("open"), F.min("ts").alias("first_ts"), F.max_by("px", "ts").alias("close"), F.max("ts").alias("last_ts"),
        F.max("px").alias("high"), F.min("px").alias("low"), F.sum("px").alias("sum_px"), F.count("px").alias("n_px"),
        F.sum("value").alias("volume"), F.count(F.lit(1)).alias("n_ticks")) \
        .select("market_id", F.col("w.start").alias("ds"), "open", "first_ts", "close", "last_ts", "high", "low", "sum_px", "n_px",
                "volume", "n_ticks")


def merge_bars(partial: DataFrame) -> DataFrame:
    """Bars from any number of partial bars per (market, hour)."""
    return partial.groupBy(*BAR_KEYS).agg(
        F.min_by("open", "first_ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "last_ts").alias("close"), F.try_divide(F.sum("sum_px"), F.sum("n_px")).alias("mean_px"),
        F.sum("volume").alias("volume"), F.sum("n_ticks").alias("n_ticks"))


def stream_bars(spark: SparkSession, folder: str, out_path: str, checkpoint: str, pattern: str = "*.parquet",
                max_files: int = 1000) -> None:
    """Land the partial bars of the tick files in ``folder`` until caught up (availableNow)."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files).parquet(folder))
    q = (src.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(batch_lander(out_path)).trigger(availableNow=True).start())
    q.awaitTermination()


def batch_lander(out_path: str):
    """foreachBatch handler: each micro-batch overwrites its own ``batch_id=N`` folder."""
    def land(batch: DataFrame, batch_id: int) -> None:
        partial_bars(batch).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
    return land


def merged_bars(spark: SparkSession, out_path: str) -> DataFrame:
    """The bars of everything landed by ``stream_bars``."""
    return merge_bars(spark.read.parquet(out_path))
