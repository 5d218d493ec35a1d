"""Skew-safe variant of the per-market block (C1 -> C2/C3 -> F1-F9).

The default block partitions windows by ``market_id``, so one market's candles meet in
one task; that is bounded by a market's hourly lifetime.  Where a single market may hold
a large share of all rows, this variant keeps every task bounded:

* whole-market values (expiry, first close, caps) are aggregations, combined map-side, gathered in
  one table and joined back on (market, time chunk), so a hot market's rows never meet on its key
  alone; the exact p99 caps come from values ranked inside their market by a range-partitioned
  running count (``ordered.group_quantile``);
* the row index comes from counts per (market, time chunk), prefix-summed over the
  market's chunk table, plus a row number inside the time chunk;
* lags and the previous-k rolling stats are windows over fixed-size row chunks, each
  chunk carrying a halo copy of the last ``HALO`` rows of the chunk before it;
* the expanding std combines chunk-level prefix sums (shifted by the market's first
  close, for conditioning) with a running sum inside the chunk.

Results equal the default block (the expanding std up to float rounding).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.candles import CLIP_COLUMNS, MISSING_FLAG_SOURCES, missing_flags
from candlewick.operators.features import ensure_flag_columns, feat_microstructure
from candlewick.operators.ordered import group_quantile, spread
from candlewick.session import write_and_read

KEY = "market_id"
HALO = 3            # the deepest look-back: rolling windows of the previous 3 rows
ROW_CHUNK = 512     # rows per window task of one market
TIME_CHUNK_HOURS = 720


def _order(df: DataFrame) -> list[str]:
    return ["ds"] + (["pos"] if "pos" in df.columns else [])


def _row_index(df: DataFrame, hours: int) -> DataFrame:
    """``_r``: 0-based position of every candle inside its market, in (ds, pos) order; ``_n_all``: the market's
    candle count; ``_tc``: the time chunk.  Market totals come from the chunk table, joined on (market, chunk)."""
    tc = F.floor(F.unix_seconds(F.col("ds").cast("timestamp")) / (hours * 3600)).cast("long")
    x = df.withColumn("_tc", tc)
    counts = x.groupBy(KEY, "_tc").agg(F.count(F.lit(1)).alias("_cnt"))
    chunks = Window.partitionBy(KEY).orderBy("_tc")                                              # chunk table
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    every = chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(KEY, "_tc", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(every).alias("_n_all"))
    inside = Window.partitionBy(KEY, "_tc").orderBy(*_order(df))
    return x.join(offsets, [KEY, "_tc"]).withColumn("_r", F.col("_off") + F.row_number().over(inside) - 1).drop("_off")


def _market_values(x: DataFrame, q: float, approx: bool) -> DataFrame:
    """One row per market: expiry, first close and the volume / open-interest caps (exact from ranked values,
    or a bounded sketch when ``approx``)."""
    first_key = F.when(F.col("close").isNotNull(), F.struct(*_order(x)))
    caps = [F.percentile_approx(c, q, 10000).alias(f"_cap_{c}") for c in CLIP_COLUMNS] if approx else []
    market = x.groupBy(KEY).agg(F.max("ds").alias("market_end_ts"), F.min_by("close", first_key).alias("first_close"), *caps)
    for c in [] if approx else CLIP_COLUMNS:
        market = market.join(group_quantile(x, KEY, c, q, f"_cap_{c}", "_tc"), KEY, "left")
    return market


def _clip(x: DataFrame) -> DataFrame:
    """C3 with the caps at hand."""
    out = {}
    for c in CLIP_COLUMNS:
        cap = F.col(f"_cap_{c}")
        out[c] = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(
            F.when(cap.isNull(), F.col(c)).otherwise(F.least(F.col(c), cap)))
    return x.withColumns(out).drop(*[f"_cap_{c}" for c in CLIP_COLUMNS])


def _lag(c: str, k: int, w) -> Column:
    return F.lag(c, k).over(w)


def prepared_chunked(flat: DataFrame, q: float = 0.99, approx_clip: bool = False, row_chunk: int = ROW_CHUNK,
                     time_chunk_hours: int = TIME_CHUNK_HOURS, pin: bool = True) -> DataFrame:
    """C1 -> C2 + C3 -> F1-F9 with every task bounded by ``row_chunk`` rows (plus halo).

    The block reads its intermediate tables several times (counts, caps, halo copies,
    chunk sums); ``pin`` writes them once to the shared checkpoint folder.
    """
    keep = write_and_read if pin else (lambda d, name="": d)
    flat = keep(flat, "chunked-input")
    # Drop each market's last candle (row index against the market's candle count)
    x = _row_index(flat, time_chunk_hours)
    x = keep(missing_flags(x.where(F.col("_r") < F.col("_n_all") - 1).drop("_n_all")), "chunked-trimmed")
    # C2 + C3: every whole-market value in one table, met on (market, time chunk)
    market = keep(spread(_market_values(x, q, approx_clip), x, KEY, "_tc"), "chunked-markets")
    x = keep(feat_microstructure(_clip(x.join(market, [KEY, "_tc"]).drop("_tc"))), "chunked-rows")
    # row chunks with a halo of the previous chunk's last HALO rows
    x = x.withColumn("_rc", F.floor(F.col("_r") / row_chunk).cast("long"))
    halo = x.where(F.col("_r") % row_chunk >= row_chunk - HALO).withColumn("_rc", F.col("_rc") + 1)
    y = x.withColumn("_halo", F.lit(False)).unionByName(halo.withColumn("_halo", F.lit(True)))
    w = Window.partitionBy(KEY, "_rc").orderBy("_r")
    prev = lambda k: w.rowsBetween(-k, -1)
    y = y.withColumns({
        "close_lag1": _lag("close", 1, w), "close_lag2": _lag("close", 2, w),
        "_ask_prev": _lag("ask_close", 1, w), "_bid_prev": _lag("bid_close", 1, w),
        "_spread_prev": _lag("bid_ask_spread", 1, w), "_vol_prev": _lag("volume", 1, w),
        "_oi_prev": _lag("open_interest", 1, w),
        **{f"close_roll_mean_{k}h": F.avg("close").over(prev(k)) for k in (2, 3)},
        **{f"close_roll_std_{k}h": F.stddev_samp("close").over(prev(k)) for k in (2, 3)},
        **{f"vol_roll_sum_{k}h": F.sum("volume").over(prev(k)) for k in (2, 3)},
    }).where(~F.col("_halo"))
    c = F.col
    y = y.withColumns({
        "momentum_1h": c("close") - c("close_lag1"), "momentum_2h": c("close") - c("close_lag2"),
        "ask_momentum": c("ask_close") - c("_ask_prev"), "bid_momentum": c("bid_close") - c("_bid_prev"),
        "spread_change": c("bid_ask_spread") - c("_spread_prev"),
        "volume_delta": c("volume") - c("_vol_prev"), "oi_delta": c("open_interest") - c("_oi_prev"),
        "vol_to_oi": F.try_divide(c("volume"), c("open_interest") + F.lit(1e-6)),
        "log_volume": F.log1p(c("volume")), "log_oi": F.log1p(c("open_interest")),
        "hours_to_expiry": (F.unix_micros(c("market_end_ts").cast("timestamp"))
                            - F.unix_micros(c("ds").cast("timestamp"))) / 3.6e9,
        "hour_index": c("_r").cast("int"),
        "close_is_floor": F.coalesce(c("close") <= 0.01, F.lit(False)).cast("int"),
        "close_is_ceiling": F.coalesce(c("close") >= 0.99, F.lit(False)).cast("int"),
        "close_vs_open": c("close") - c("first_close"),
    }).withColumns({
        "is_final_3h": F.coalesce(c("hours_to_expiry") <= 3, F.lit(False)).cast("int"),
        "is_final_1h": F.coalesce(c("hours_to_expiry") <= 1, F.lit(False)).cast("int"),
    })
    y = _running_std(keep(y, "chunked-features"), row_chunk)
    return ensure_flag_columns(y.drop("_r", "_rc", "_halo", "_ask_prev", "_bid_prev", "_spread_prev", "_vol_prev",
                                      "_oi_prev"))


def _running_std(y: DataFrame, row_chunk: int) -> DataFrame:
    """Expanding sample std of close (current row included) from chunk prefix sums."""
    d = F.col("close") - F.coalesce(F.col("first_close"), F.lit(0.0))
    y = y.withColumns({"_n1": F.col("close").isNotNull().cast("long"), "_s1": F.coalesce(d, F.lit(0.0)),
                       "_q1": F.coalesce(d * d, F.lit(0.0))})
    chunks = y.groupBy(KEY, "_rc").agg(F.sum("_n1").alias("_cn"), F.sum("_s1").alias("_cs"), F.sum("_q1").alias("_cq"))
    before = Window.partitionBy(KEY).orderBy("_rc").rowsBetween(Window.unboundedPreceding, -1)  # chunk table
    pre = chunks.select(KEY, "_rc", *[F.coalesce(F.sum(f"_c{s}").over(before), F.lit(0)).alias(f"_p{s}")
                                      for s in ("n", "s", "q")])
    run = Window.partitionBy(KEY, "_rc").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    y = y.join(pre, [KEY, "_rc"]).withColumns({
        "_n": F.col("_pn") + F.sum("_n1").over(run), "_s": F.col("_ps") + F.sum("_s1").over(run),
        "_q": F.col("_pq") + F.sum("_q1").over(run)})
    var = (F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1)
    std = F.when(F.col("_n") >= 2, F.sqrt(F.greatest(var, F.lit(0.0))))
    return y.withColumn("running_std", std).drop("_n1", "_s1", "_q1", "_pn", "_ps", "_pq", "_n", "_s", "_q")


__all__ = ["prepared_chunked", "MISSING_FLAG_SOURCES"]
