"""Cleaning operators on the flat candle table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import SENTINEL
from candlewick.operators.windows import KEY, w_all, w_ordered, w_running

MISSING_FLAG_SOURCES = ["price_mean", "bid_close", "ask_close"]
CLIP_COLUMNS = ["volume", "open_interest"]


def drop_last(df: DataFrame, key: str = KEY, order: str = "ds") -> DataFrame:
    """Drop the last candle of each market (a one-candle market disappears)."""
    w = w_ordered(df, key, order)
    n = F.count(F.lit(1)).over(w_all(df, key, order))
    return (df.withColumn("_rn", F.row_number().over(w)).withColumn("_n", n)
              .where(F.col("_rn") < F.col("_n")).drop("_rn", "_n"))


def dropped_last_count(df: DataFrame, key: str = KEY) -> DataFrame:
    """How many resolution candles C1 removes: one per market."""
    return df.agg(F.countDistinct(key).alias("dropped"))


def missing_flags(df: DataFrame, cols=None) -> DataFrame:
    """0/1 flags for missing price_mean, bid_close, ask_close."""
    cols = [c for c in (cols or MISSING_FLAG_SOURCES) if c in df.columns]
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in cols})


def clip_quantile(df: DataFrame, cols=None, key: str = KEY, q: float = 0.99,
                  approx: bool = False, order: str = "ds", expanding: bool = False) -> DataFrame:
    """Cap each column at its market's own ``q`` quantile (linear interpolation).

    The default uses the whole market (as the reference does, a look-ahead in training);
    ``expanding=True`` caps each candle at the quantile of the candles up to it.  The
    per-market frame is bounded by the market's hourly lifetime; ``approx=True`` switches
    to ``percentile_approx`` for very long-lived markets.
    """
    cols = [c for c in (cols or CLIP_COLUMNS) if c in df.columns]
    w = w_running(df, key, order) if expanding else w_all(df, key, order)
    out = {}
    for c in cols:
        cap = (F.percentile_approx(c, q, 10000) if approx else F.percentile(c, q)).over(w)
        out[c] = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(
            F.when(cap.isNull(), F.col(c)).otherwise(F.least(F.col(c), cap)))
    return df.withColumns(out)


def preprocess(df: DataFrame, clip: bool = True, flags: bool = True, q: float = 0.99) -> DataFrame:
    """C4 (flags + clip), C5 (``clip=False``), C6 (``flags=False``: clip, flags forced to 0)."""
    if flags:
        df = missing_flags(df)
    if clip:
        df = clip_quantile(df, q=q)
    if not flags:
        df = df.withColumns({f"{c}_missing": F.lit(0) for c in MISSING_FLAG_SOURCES})
    return df


def filter_min_hours(df: DataFrame, hours: float = 6.0) -> DataFrame:
    """Keep rows with more than ``hours`` to expiry (strict; NULL drops)."""
    return df.where(F.col("hours_to_expiry") > hours)


def drop_unlabelled(df: DataFrame, label: str = "label") -> DataFrame:
    """C8."""
    return df.na.drop(subset=[label])


def describe_column(df: DataFrame, c: str) -> DataFrame:
    """Count, mean, std, min, exact quartiles, max of one column.

    The quartiles come from ranks: equal values are counted map-side, a range-partitioned running count
    places each value, and the two values around each quartile's rank are picked by plain aggregates.
    """
    from candlewick.operators.ordered import running_sums
    x = F.col(c)
    stats = df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                   F.min(x).alias("min"), F.max(x).alias("max")).first()
    n = stats["count"]
    per_value = df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("k"))
    ranked = running_sums(per_value, ["v"], {"upto": F.col("k")})
    picks = []
    for q in (0.25, 0.5, 0.75):
        pos = (n - 1) * q if n else 0.0
        low, part = int(pos), pos - int(pos)
        at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("v")))
        picks.append((at(low) * F.lit(1 - part) + at(min(low + 1, max(n - 1, 0))) * F.lit(part)).alias(f"p{int(q * 100)}"))
    lit = lambda name: F.lit(stats[name]).alias(name)
    return ranked.agg(*picks).select(lit("count"), lit("mean"), lit("std"), lit("min"), "p25", "p50", "p75", lit("max"))


def fill_sentinel(df: DataFrame, cols, value: float = SENTINEL) -> DataFrame:
    """NULL -> sentinel in the feature columns (NaN is already NULL here)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(value))) for c in cols})
