"""L2: streaming de-duplication: within a watermark, or against everything landed so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dedupe_stream(stream: DataFrame, keys: list[str], ts: str, watermark: str = "2 hours") -> DataFrame:
    """Keeps the first arrival of each key; for payload-identical copies first == last."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark) \
        .dropDuplicatesWithinWatermark(keys)


def run_to_folder(stream: DataFrame, out_path: str, checkpoint: str) -> int:
    """Run a stream to a Parquet folder until caught up; returns the rows dropped as older than the watermark."""
    q = (stream.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(int(op.numRowsDroppedByWatermark) for p in q.recentProgress for op in p.stateOperators)


def land_distinct(stream: DataFrame, keys: list[str], out_path: str, checkpoint: str) -> None:
    """Keep the first arrival of each key for ever, whatever its age: each micro-batch drops its own repeats
    and the keys landed by earlier batches, and overwrites its own folder, so a replay changes nothing."""
    spark = stream.sparkSession

    def land(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates(keys)
        if batch_id > 0:
            landed = spark.read.option("basePath", out_path).parquet(f"{out_path}/batch_id=*").where(F.col("batch_id") < batch_id)
            fresh = fresh.join(landed.select(*keys), keys, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land).trigger(availableNow=True).start())
    q.awaitTermination()


def replayed_events(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """The same event files read as two streams (every record arrives twice)."""
    from candlewick.streaming.bars import file_stream
    return file_stream(spark, folder, pattern).unionByName(file_stream(spark, folder, pattern))
