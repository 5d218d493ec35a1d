"""Composed flows over the candle table (lazy DataFrames; nothing is collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.config import DEFAULT_CONFIG, PipelineConfig
from candlewick.operators import candles as C
from candlewick.operators import features as FE
from candlewick.sources import fixtures


def prepared(flat: DataFrame, cfg: PipelineConfig = DEFAULT_CONFIG, clip: bool = True, flags: bool = True,
             drop_resolution: bool = True) -> DataFrame:
    """C1 -> C4 (or C5/C6) -> F1-F9, before the expiry filter.

    With ``cfg.skew_safe`` the full C1 -> C4 -> F block runs on bounded row chunks instead
    of one window partition per market (same results).
    """
    if cfg.skew_safe:
        if not (clip and flags and drop_resolution):
            raise ValueError("the skew-safe block covers C1 + C4 only: clip, flags and drop_resolution must be on")
        from candlewick.operators.chunked import prepared_chunked
        return prepared_chunked(flat, q=cfg.clip_quantile)
    df = C.drop_last(flat) if drop_resolution else flat
    df = C.preprocess(df, clip=clip, flags=flags, q=cfg.clip_quantile)
    return FE.engineer_features(df)


def model_rows(feat: DataFrame, cfg: PipelineConfig = DEFAULT_CONFIG, min_hours: bool = True) -> DataFrame:
    """C7 -> C8."""
    if min_hours:
        feat = C.filter_min_hours(feat, cfg.min_hours_to_expiry)
    return C.drop_unlabelled(feat)


def feature_frame(spark: SparkSession, sf_dir: str, cfg: PipelineConfig = DEFAULT_CONFIG) -> DataFrame:
    return prepared(fixtures.candle_flat(spark, sf_dir), cfg)


def model_frame(spark: SparkSession, sf_dir: str, cfg: PipelineConfig = DEFAULT_CONFIG) -> DataFrame:
    return model_rows(feature_frame(spark, sf_dir, cfg), cfg)


def materialised(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it from there.

    Used before operators that read their input more than once (group split: distinct
    groups and the join back), so the per-market windows run a single time.
    """
    from candlewick.session import write_and_read
    return write_and_read(df, "model-rows")


def series_summary(rows: DataFrame) -> DataFrame:
    """Per-series label share and mean one-hour momentum (the flagship report)."""
    return rows.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("market_id").alias("n_markets"),
        F.avg("label").alias("label_share"),
        F.avg("momentum_1h").alias("mean_momentum_1h"),
    )


def surrogate_prob(df: DataFrame, name: str = "prob") -> DataFrame:
    """Model-free score with the ensemble's 0.6/0.4 weights (for checks of evaluation ops)."""
    x = 0.6 * F.coalesce("ask_close", "close") + 0.4 * F.coalesce("price_mean", "close")
    return df.withColumn(name, F.least(F.greatest(x, F.lit(0.01)), F.lit(0.99)))
