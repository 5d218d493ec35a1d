"""L3: rescore every market touched by newly landed candles.

Hours to expiry depends on a market's latest candle, so one new candle changes all of
that market's features: each micro-batch appends its candles to the store, re-reads the
full history of the touched markets only and rescores them.  The store is partitioned by
a hash bucket of the market, and the history read joins on (bucket, market), so dynamic
partition pruning limits each batch to the buckets it touched instead of the whole
store.  The result table keeps the newest score per market.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


STORE_BUCKETS = 64      # default only; size it so that a bucket holds a few thousand markets


def market_bucket(key: str = "market_id", buckets: int = STORE_BUCKETS):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def run_stream_scoring(spark: SparkSession, landing: str, store: str, scores: str, checkpoint: str,
                       score_fn: Callable[[DataFrame], DataFrame], schema, buckets: int = STORE_BUCKETS,
                       max_files: int = 64) -> None:
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landing)

    def step(batch: DataFrame, batch_id: int) -> None:
        # Each batch owns its folders and overwrites them: a replayed batch replaces, never duplicates.
        own = f"{store}/batch_id={batch_id}"
        batch.withColumn("mbucket", market_bucket(buckets=buckets)).write.mode("overwrite").partitionBy("mbucket").parquet(own)
        touched = spark.read.parquet(own).select("mbucket", "market_id").distinct()     # the written batch, read once more
        history = spark.read.parquet(store).where(F.col("batch_id") <= batch_id).join(touched, ["mbucket", "market_id"], "left_semi") \
            .drop("mbucket", "batch_id")
        score_fn(history).write.mode("overwrite").parquet(f"{scores}/batch_id={batch_id}")

    q = (src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def compact(spark: SparkSession, store: str, fresh: str) -> str:
    """Rewrite a store's batches as one batch (the newest id) of a new store, one folder per bucket, so that the
    folders read and listed per batch stay few.  Run between stream runs, then stream on with ``fresh``."""
    old = spark.read.parquet(store)
    last = old.agg(F.max("batch_id")).first()[0]
    old.drop("batch_id").repartition("mbucket").write.mode("overwrite").partitionBy("mbucket").parquet(f"{fresh}/batch_id={last}")
    return fresh


def latest_scores(spark: SparkSession, scores: str, key: str = "market_id") -> DataFrame:
    landed = spark.read.parquet(scores)
    cols = [c for c in landed.columns if c not in (key, "batch_id")]
    return landed.groupBy(key).agg(F.max_by(F.struct(*cols), "batch_id").alias("s")).select(key, "s.*")
