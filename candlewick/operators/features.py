"""Per-market time-series features.

Input: the frame after C1 and C4.  All windows share one partitioning and order, so
the whole block is one Exchange (or none, when the input is already partitioned by
market_id) and one Sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import ALL_FEATURE_COLS
from candlewick.operators.candles import MISSING_FLAG_SOURCES
from candlewick.operators.windows import KEY, w_all, w_ordered, w_prev, w_running

c = F.col


def feat_microstructure(df: DataFrame) -> DataFrame:
    """F1."""
    return df.withColumns({
        "bid_ask_spread": c("ask_close") - c("bid_close"),
        "midpoint": (c("ask_close") + c("bid_close")) / 2,
    }).withColumns({
        "close_vs_mid": c("close") - c("midpoint"),
        "price_range": c("high") - c("low"),
        "ask_range": c("ask_high") - c("ask_low"),
        "bid_range": c("bid_high") - c("bid_low"),
        "close_vs_mean": c("close") - c("price_mean"),
    })


def feat_lags(df: DataFrame, key: str = KEY) -> DataFrame:
    """row lags (not clock lags)."""
    w = w_ordered(df, key)
    return df.withColumns({"close_lag1": F.lag("close", 1).over(w), "close_lag2": F.lag("close", 2).over(w)})


def feat_momentum(df: DataFrame, key: str = KEY) -> DataFrame:
    """F3 (needs F1 and F2)."""
    w = w_ordered(df, key)
    return df.withColumns({
        "momentum_1h": c("close") - c("close_lag1"),
        "momentum_2h": c("close") - c("close_lag2"),
        "ask_momentum": c("ask_close") - F.lag("ask_close", 1).over(w),
        "bid_momentum": c("bid_close") - F.lag("bid_close", 1).over(w),
        "spread_change": c("bid_ask_spread") - F.lag("bid_ask_spread", 1).over(w),
    })


def feat_volume(df: DataFrame, key: str = KEY) -> DataFrame:
    """F4."""
    w = w_ordered(df, key)
    return df.withColumns({
        "volume_delta": c("volume") - F.lag("volume", 1).over(w),
        "oi_delta": c("open_interest") - F.lag("open_interest", 1).over(w),
        "vol_to_oi": F.try_divide(c("volume"), c("open_interest") + F.lit(1e-6)),
        "log_volume": F.log1p(c("volume")),
        "log_oi": F.log1p(c("open_interest")),
    })


def feat_time(df: DataFrame, key: str = KEY, expiry: str | None = None) -> DataFrame:
    """expiry = last candle time of the (already trimmed) market (the default, which looks
    ahead in training), or the market's own close time held in column ``expiry``."""
    w = w_ordered(df, key)
    end = F.max("ds").over(w_all(df, key)) if expiry is None else F.col(expiry).cast("timestamp")
    df = df.withColumn("market_end_ts", end).withColumn(
        "hours_to_expiry",
        (F.unix_micros(c("market_end_ts").cast("timestamp")) - F.unix_micros(c("ds").cast("timestamp"))) / 3.6e9)
    return df.withColumns({
        "is_final_3h": F.coalesce(c("hours_to_expiry") <= 3, F.lit(False)).cast("int"),
        "is_final_1h": F.coalesce(c("hours_to_expiry") <= 1, F.lit(False)).cast("int"),
        "hour_index": F.row_number().over(w) - 1,
    })


def feat_rolling(df: DataFrame, key: str = KEY, widths=(2, 3)) -> DataFrame:
    """stats of the previous ``w`` rows (current row excluded)."""
    out = {}
    for k in widths:
        wp = w_prev(df, k, key)
        out[f"close_roll_mean_{k}h"] = F.avg("close").over(wp)
        out[f"close_roll_std_{k}h"] = F.stddev_samp("close").over(wp)
        out[f"vol_roll_sum_{k}h"] = F.sum("volume").over(wp)
    return df.withColumns(out)


def feat_level(df: DataFrame, key: str = KEY) -> DataFrame:
    """floor/ceiling flags, first non-null close of the market, distance to it."""
    return df.withColumns({
        "close_is_floor": F.coalesce(c("close") <= 0.01, F.lit(False)).cast("int"),
        "close_is_ceiling": F.coalesce(c("close") >= 0.99, F.lit(False)).cast("int"),
        "first_close": F.first("close", ignorenulls=True).over(w_all(df, key)),
    }).withColumn("close_vs_open", c("close") - c("first_close"))


def feat_running_std(df: DataFrame, key: str = KEY) -> DataFrame:
    """F8: expanding sample std including the current row."""
    return df.withColumn("running_std", F.stddev_samp("close").over(w_running(df, key)))


def ensure_flag_columns(df: DataFrame) -> DataFrame:
    """add missing-flag columns as 0 when absent."""
    missing = {f"{s}_missing": F.lit(0) for s in MISSING_FLAG_SOURCES if f"{s}_missing" not in df.columns}
    return df.withColumns(missing) if missing else df


def engineer_features(df: DataFrame, key: str = KEY, expiry: str | None = None) -> DataFrame:
    """F1-F9 in reference order (``expiry``: see ``feat_time``)."""
    df = feat_microstructure(df)
    df = feat_lags(df, key)
    df = feat_momentum(df, key)
    df = feat_volume(df, key)
    df = feat_time(df, key, expiry)
    df = feat_rolling(df, key)
    df = feat_level(df, key)
    df = feat_running_std(df, key)
    return ensure_flag_columns(df)


def feature_columns(df: DataFrame, cols=None) -> list[str]:
    """Registry order, keeping only columns that exist."""
    return [x for x in (cols or ALL_FEATURE_COLS) if x in df.columns]


def feature_table(df: DataFrame, keys=("market_id", "series_id", "ds", "label")) -> DataFrame:
    """keys + the model columns in registry order."""
    return df.select(*[k for k in keys if k in df.columns], *feature_columns(df))
