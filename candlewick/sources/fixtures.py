"""Market tables derived from the driver tables.

``candles`` turns the ``events`` tick stream into sparse hourly bars (a series is a
user, a market is user x event type).  ``raw_markets`` turns ``orders`` into two
overlapping market-metadata sources.  Both are plain DataFrame plans, so their work
grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.functions.columns import series_id_col
from candlewick.sources.tables import table

# --- fixed values: keyword list used with the raw_markets fixture ---
FIXTURE_KEYWORDS = ["urgent", "high", "not specified"]


def hourly_ticks(events: DataFrame) -> DataFrame:
    """Ticks with market key, hour bucket, capped price and the integer ``k`` of ``props``."""
    return events.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_type")).alias("market_id"),
        F.date_trunc("hour", F.col("ts")).alias("ds"),
        F.col("ts"),
        F.col("value"),
        F.least(F.col("value") / 100.0, F.lit(1.0)).alias("px"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("int").alias("k"),
        F.col("user_id"),
        F.col("event_type"),
    )


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat hourly candles (15 columns) from ``events``.

    Plan: partial aggregation on (market, hour) -> one exchange on market_id for the
    label window; later per-market windows reuse that partitioning.
    """
    t = hourly_ticks(table(spark, sf_dir, "events"))
    # user_id and event_type are functions of market_id: grouping on them keeps every
    # aggregation buffer fixed-width (hash aggregation, map-side combine).
    bars = t.groupBy("market_id", "ds", "user_id", "event_type").agg(
        F.max_by("px", "ts").alias("close"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.avg("px").alias("mean_px"),
        F.sum("value").alias("volume"),
        F.max_by("k", "ts").alias("k"),
    )
    # Ordered like the later per-market windows, so one sort serves them all.
    whole_market = Window.partitionBy("market_id").orderBy("ds").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    avg_close = F.round(F.avg("close").over(whole_market), 6)
    k = F.col("k")
    return bars.select(
        "market_id", "ds", "close", "high", "low",
        F.when((F.col("event_type") == "signup") & (F.col("user_id") % 10 == 0), F.lit(None))
         .when(avg_close >= 0.45, F.lit(1)).otherwise(F.lit(0)).cast("double").alias("label"),
        "volume",
        k.cast("double").alias("open_interest"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("close")).alias("ask_close"),
        F.col("high").alias("ask_high"),
        F.col("low").alias("ask_low"),
        F.when(k % 7 == 0, F.lit(None))
         .otherwise(F.greatest(F.col("close") - 0.01 * (1 + k % 5), F.lit(0.0))).alias("bid_close"),
        (F.col("high") * 0.9).alias("bid_high"),
        (F.col("low") * 0.9).alias("bid_low"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("mean_px")).alias("price_mean"),
    )


def candle_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``candles`` in the 17-column flattened-candle shape (adds series_id, end_period_ts)."""
    c = candles(spark, sf_dir)
    return c.select(
        "market_id", series_id_col("market_id").alias("series_id"), "ds", "close", "high", "low", "label",
        "volume", "open_interest", F.unix_timestamp("ds").alias("end_period_ts"),
        "ask_close", "ask_high", "ask_low", "bid_close", "bid_high", "bid_low", "price_mean",
    )


def raw_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market metadata from ``orders``: two overlapping sources with every reject reason."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cu"), F.col("o_orderstatus").alias("st"),
        F.col("o_orderpriority").alias("pr"), F.col("o_totalprice").alias("tp"), F.col("o_orderdate").alias("od"))
    k, cu, pr, tp, od = F.col("k"), F.col("cu"), F.col("pr"), F.col("tp"), F.col("od")
    s = (o.where(k % 3 != 0).select(F.lit(0).alias("src"), "*")
         .unionByName(o.where(k % 2 == 0).select(F.lit(1).alias("src"), "*")))
    hour = F.expr("INTERVAL 1 HOUR")
    dec = lambda x: x.cast("decimal(10,4)").cast("string")
    return s.select(
        "src", k.alias("seq"),
        F.concat(F.lit("O"), F.expr("k div 160").cast("string"), F.lit("-"), F.expr("k div 4").cast("string")).alias("ticker"),
        F.concat(F.lit("O"), F.expr("k div 160").cast("string")).alias("event_ticker"),
        F.when(F.col("st") == "F", "finalized").when(F.col("st") == "P", "closed").otherwise("active").alias("status"),
        F.when(k % 17 == 0, "scalar").otherwise("binary").alias("market_type"),
        F.when(k % 19 == 0, F.concat(F.lit("MVE"), cu.cast("string")))
         .when(k % 2 == 0, F.lit("")).otherwise(F.lit(None)).alias("mve_collection_ticker"),
        F.when(k % 23 == 0, "").when(tp > 250000, "yes").otherwise("no").alias("result"),
        F.when(k % 4 == 0, F.lit("  ")).when(k % 4 == 1, F.lit(None))
         .otherwise(F.concat(F.lit(" If "), pr, F.lit(" ships then Yes "))).alias("rules_primary"),
        F.when(k % 5 == 0, pr).otherwise(F.lit("")).alias("yes_sub_title"),
        F.when(k % 7 == 0, pr).alias("no_sub_title"),
        F.when(k % 11 == 0, F.concat(F.lit("assoc "), pr)).alias("associated_markets"),
        F.concat(F.lit("title "), pr).alias("title"),
        od.alias("open_time"),
        F.when(k % 6 == 0, F.lit(None))
         .when(cu % 10 == 0, od + F.expr("INTERVAL 30 MINUTES"))
         .when(cu % 10 == 1, od - hour)
         .otherwise(od + F.expr("INTERVAL 48 HOURS")).alias("close_time"),
        F.when(k % 12 == 0, od + F.expr("INTERVAL 5 HOURS")).alias("settlement_ts"),
        dec(tp / 500000.0).alias("yes_ask_dollars"),
        dec(1 - tp / 500000.0).alias("no_ask_dollars"),
        dec(tp / 510000.0).alias("last_price_dollars"),
        F.when(k % 29 == 0, F.lit("")).otherwise(k.cast("string")).alias("volume_fp"),
    )


def _uid(market_id: str = "market_id"):
    return F.regexp_extract(F.col(market_id), r"^U([0-9]+)", 1).cast("int")


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def market_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market metadata for the candle markets (ISO text times, as a market API returns them).

    Covers every life-window outcome: usable, missing times, end <= start and < 1 hour.
    """
    m = candle_flat(spark, sf_dir).groupBy("market_id", "series_id").agg(
        F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"), F.max("label").alias("label"))
    u = _uid()
    hour = F.expr("INTERVAL 1 HOUR")
    return m.select(
        F.col("market_id").alias("ticker"), F.col("series_id").alias("event_ticker"),
        F.when(u % 11 == 0, F.lit(None)).otherwise(_iso(F.col("first_ds") - hour)).alias("open_time"),
        F.when(u % 7 == 0, F.lit(None))
         .when(u % 5 == 0, _iso(F.col("first_ds") - F.expr("INTERVAL 30 MINUTES")))
         .otherwise(_iso(F.col("last_ds") - F.expr("INTERVAL 24 HOURS"))).alias("close_time"),
        F.when(u % 2 == 0, _iso(F.col("last_ds"))).alias("settlement_ts"),
        "label",
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw quote candles (nested yes-ask prices as text) for the candle markets."""
    f = candle_flat(spark, sf_dir)
    t = lambda c: F.col(c).cast("string")
    return f.select(
        "market_id", F.col("series_id").alias("event_ticker"), "end_period_ts",
        F.struct(t("ask_high").alias("high_dollars"), t("ask_low").alias("low_dollars"),
                 t("ask_close").alias("close_dollars")).alias("yes_ask"),
    )
