"""Source / sink queries (S*) and streaming queries (L*): write through the real format,
read back, and compare with the same oracle as the in-memory operator."""

from __future__ import annotations

from pyspark.sql import functions as F


from candlewick.functions.columns import to_float, zero_default
from candlewick.operators import candles as C
from candlewick.operators import features as FE
from candlewick.operators import models as T
from candlewick.operators import scoring as SC
from candlewick.plans import flows, training
from candlewick.plans.oracle import final_select, metrics_sql, with_ctes
from candlewick.plans.q_eval import _LIVE_CTES
from candlewick.plans.q_markets import _dedup, _raw
from candlewick.plans.registry import query
from candlewick.session import scratch_path
from candlewick.sources import fixtures, io, live, nested
from candlewick.streaming import bars, dedupe, scoring

_VAL = "(SELECT * FROM scored WHERE split = 'val')"
FLAT_SPEC = ("market_id, series_id, ds:t, close:d, high:d, low:d, label:d, volume:d, open_interest:d, end_period_ts:i, "
             "ask_close:d, ask_high:d, ask_low:d, bid_close:d, bid_high:d, bid_low:d, price_mean:d")
MARKET_COLS = ["ticker", "event_ticker", "status", "market_type", "result", "yes_ask_dollars", "volume_fp"]


@query("read_market_timeseries", with_ctes("flat") + final_select(FLAT_SPEC, "flat"))
def read_market_timeseries(spark, sf_dir):
    """Candle documents (one per market) written twice, the later folder carrying the
    true values; reading the folders merges per market with the later file winning."""
    flat = fixtures.candle_flat(spark, sf_dir)
    root = scratch_path(spark, "timeseries")
    stale = flat.withColumn("close", F.col("close") + 1.0)  # superseded by the second folder
    for i, part in enumerate([stale, flat]):
        docs = nested.to_documents(nested.nest_candles(part))
        io.write_table(docs.select("value"), f"{root}/v{i}", "text")
    return nested.flatten(nested.read_documents(spark, f"{root}/v*/", multiline=False)).select(*nested.FLAT_COLUMNS)


@query("read_timeseries_whole", with_ctes("flat") + final_select(
    "market_id, n_candles:i, last_ds:t, n_rejected:i",
    "(SELECT market_id, count(*) AS n_candles, max(ds) AS last_ds, 1 AS n_rejected FROM flat GROUP BY market_id)"))
def read_timeseries_whole(spark, sf_dir):
    """S1, whole-file form: files that each hold one document of many markets, one of them cut off in the
    middle; the good documents are read and the broken one is reported."""
    path = scratch_path(spark, "whole")
    docs = nested.nest_candles(fixtures.candle_flat(spark, sf_dir)).withColumn("part", F.pmod(F.xxhash64("market_id"), F.lit(64)))
    io.write_table(nested.to_documents(docs, "part").select("part", "value"), path, "text", partition_by=["part"])
    cut = spark.createDataFrame([("cut", '{"CUT-1": [{"ds": "2024-01-01 00:00:00", "clo')], "part string, value string")
    io.write_table(cut, path, "text", mode="append", partition_by=["part"])
    n = nested.rejected_documents(spark, path).count()
    back = nested.read_documents(spark, path, broken="skip")
    return back.select("market_id", F.size("candles").alias("n_candles"),
                       F.to_timestamp(F.element_at("candles", -1)["ds"]).alias("last_ds"), F.lit(n).alias("n_rejected"))


@query("read_markets_json", with_ctes("dedup") + final_select(", ".join(MARKET_COLS), "dedup"))
def read_markets_json(spark, sf_dir):
    """Market metadata landed as files of JSON arrays and read with an explicit schema."""
    path = io.write_market_arrays(_dedup(spark, sf_dir, *MARKET_COLS).select(*MARKET_COLS), scratch_path(spark, "markets"))
    return io.read_markets(spark, path).select(*MARKET_COLS)


@query("write_json", with_ctes("dedup") + final_select(", ".join(MARKET_COLS), "dedup"))
def write_json(spark, sf_dir):
    """S3: overwrite replaces what a previous write left."""
    path = scratch_path(spark, "overwrite")
    d = _dedup(spark, sf_dir, *MARKET_COLS).select(*MARKET_COLS)
    io.write_table(d.where("status = 'active'"), path, "json")
    io.write_table(d, path, "json", mode="overwrite")
    return io.read_table(spark, path, "json", io.MARKET_SCHEMA).select(*MARKET_COLS)


@query("append_json", with_ctes("raw_markets") + final_select("src:i, seq:i, ticker", "raw_markets"))
def append_json(spark, sf_dir):
    """Appending the recent source after the historical one (valid NDJSON)."""
    path = scratch_path(spark, "append")
    raw = _raw(spark, sf_dir).select("src", "seq", "ticker")
    io.write_table(raw.where("src = 0"), path, "json")
    io.write_table(raw.where("src = 1"), path, "json", mode="append")
    return io.read_table(spark, path, "json", "src int, seq long, ticker string")


def live_candles(spark, sf_dir):
    """Quotes as a live feed sends them (``close``, ``volume``, ``price.mean``), normalised."""
    f = fixtures.candle_flat(spark, sf_dir)
    t = lambda c: F.col(c).cast("string")
    live_rows = f.select(
        "market_id", "end_period_ts",
        F.struct(t("ask_close").alias("close"), t("ask_high").alias("high"), t("ask_low").alias("low")).alias("yes_ask"),
        F.struct(t("bid_close").alias("close"), t("bid_high").alias("high"), t("bid_low").alias("low")).alias("yes_bid"),
        F.struct(t("price_mean").alias("mean")).alias("price"),
        t("volume").alias("volume"), t("open_interest").alias("open_interest"))
    return live.normalise_candles(live_rows)


def live_flat(spark, sf_dir):
    """Live quotes -> S5 -> nested documents -> P1: the candle table the scoring path starts from."""
    n = live_candles(spark, sf_dir).withColumn("ds", F.to_timestamp("ds"))
    return nested.flatten_rows(n)


@query("normalise_live_candles", with_ctes("flat") + final_select(
    "market_id, ds, close:d=ask_close, high:d=ask_high, low:d=ask_low, bid_close:d, price_mean:d, "
    "volume:d, open_interest:d", "flat"))
def normalise_live_candles(spark, sf_dir):
    """Live-shape quotes (``close``, ``volume``, ``price.mean``) -> training candle shape."""
    n = live_candles(spark, sf_dir)
    return n.select("market_id", "ds", "close", "high", "low",
                    to_float("yes_bid.close_dollars").alias("bid_close"),
                    to_float("price.mean_dollars").alias("price_mean"),
                    zero_default("volume_fp").alias("volume"), zero_default("open_interest_fp").alias("open_interest"))


@query("save_timeseries", with_ctes("flat") + final_select(
    "market_id, n_candles:i, first_ds:t, last_ds:t",
    "(SELECT market_id, count(*) AS n_candles, min(ds) AS first_ds, max(ds) AS last_ds FROM flat GROUP BY market_id)"))
def save_timeseries(spark, sf_dir):
    """Per-market candle lists written as JSON documents (one per market), then read back."""
    path = scratch_path(spark, "series")
    io.write_table(nested.to_documents(nested.nest_candles(fixtures.candle_flat(spark, sf_dir))).select("value"),
                   path, "text")
    back = nested.read_documents(spark, path, multiline=False)
    return back.select("market_id", F.size("candles").alias("n_candles"),
                       F.to_timestamp(F.col("candles")[0]["ds"]).alias("first_ds"),
                       F.to_timestamp(F.element_at("candles", -1)["ds"]).alias("last_ds"))


@query("write_ablation_csv", with_ctes("split") + final_select(
    "ablation, val_loss:d, delta:d",
    f"(SELECT ablation, val_loss, val_loss - first_value(val_loss) OVER (ORDER BY nr) AS delta FROM ("
    f"SELECT 'surrogate' AS ablation, 0 AS nr, log_loss AS val_loss FROM {metrics_sql(_VAL)} UNION ALL "
    f"SELECT 'market price', 1, log_loss FROM {metrics_sql(_VAL, 'least(greatest(close, 0.01), 0.99)')}))"))
def write_ablation_csv(spark, sf_dir):
    """The ablation table (here of two model-free scores) through the CSV sink (header, no index) and back."""
    from candlewick.plans.q_models import ablation_delta
    path = scratch_path(spark, "csv")
    io.write_table(ablation_delta(spark, sf_dir), path, "csv")
    return io.read_table(spark, path, "csv", "ablation string, val_loss double, delta double")


@query("save_load_model", with_ctes("split") + final_select(
    "n_scored:i, max_abs_diff:d", "(SELECT count(*) AS n_scored, 0.0 AS max_abs_diff FROM test)"))
def save_load_model(spark, sf_dir):
    """Model, scaler and feature list saved, loaded back, and scoring identically."""
    from candlewick.plans.q_models import Q as Q_MODELS
    Q = Q_MODELS
    sp = training.make_splits(flows.model_frame(spark, sf_dir), Q)
    stats, rows = training.scaled(sp)
    fitted = training.fit_primary(rows, sp.cols, Q)
    path = io.save_bundle(spark, scratch_path(spark, "bundle"), {"primary": fitted.model}, stats, sp.cols)
    models, stats2, cols2 = io.load_bundle(spark, path)
    keys = ["market_id", "ds"]
    before = T.predict_prob(fitted.model, T.vectorise(sp.test, stats, sp.cols), "p_before")
    after = T.predict_prob(models["primary"], T.vectorise(sp.test, stats2, cols2), "p_after")
    both = before.select(*keys, "p_before").join(after.select(*keys, "p_after"), keys)
    return both.agg(F.count(F.lit(1)).alias("n_scored"),
                     F.max(F.abs(F.col("p_before") - F.col("p_after"))).alias("max_abs_diff"))


# ---------------------------------------------------------------- streaming (L*)
_BARS = """bars AS (
  SELECT concat('U', cast(user_id AS varchar), '-', event_type) AS market_id, date_trunc('hour', ts) AS ds,
    arg_min(least(value/100, 1.0), ts) AS open, max(least(value/100, 1.0)) AS high, min(least(value/100, 1.0)) AS low,
    arg_max(least(value/100, 1.0), ts) AS close, avg(least(value/100, 1.0)) AS mean_px, sum(value) AS volume,
    count(*) AS n_ticks
  FROM events GROUP BY 1, 2)"""
_BAR_SPEC = "market_id, ds:t, open:d, high:d, low:d, close:d, mean_px:d, volume:d, n_ticks:i"


@query("hourly_bars", with_ctes("", _BARS) + final_select(_BAR_SPEC, "bars"))
def hourly_bars(spark, sf_dir):
    """L1 (batch): ticks -> 60-minute open / high / low / close / mean / volume bars."""
    from candlewick.sources.tables import table
    return bars.hourly_bars(table(spark, sf_dir, "events"))


@query("hourly_bars_stream", with_ctes("", _BARS) + final_select(_BAR_SPEC, "bars"))
def hourly_bars_stream(spark, sf_dir):
    """L1 (stream): the same bars from a file-source stream of partial bars, merged on read (no tick is late)."""
    out, ck = scratch_path(spark, "bars"), scratch_path(spark, "bars-ck")
    bars.stream_bars(spark, sf_dir, out, ck, "events.parquet")
    return bars.merged_bars(spark, out)


@query("stream_dedupe", final_select(
    "event_type, n:i", "(SELECT event_type, count(*) AS n FROM events GROUP BY event_type)"))
def stream_dedupe(spark, sf_dir):
    """L2: every event arrives twice, over several micro-batches; the landed table holds one of each."""
    out, ck = scratch_path(spark, "dedupe"), scratch_path(spark, "dedupe-ck")
    dedupe.land_distinct(dedupe.replayed_events(spark, sf_dir, "events.parquet"), ["event_id"], out, ck)
    return spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def live_score(history):
    """Scoring function of the live path: C4 -> F -> surrogate -> I1 + I2."""
    f = FE.engineer_features(C.preprocess(history))
    return SC.with_signal(SC.score_markets(flows.surrogate_prob(f)))


@query("stream_score", with_ctes(*_LIVE_CTES) + final_select(
    "market_id, current_prob:d, candles_seen:i, signal=CASE WHEN candles_seen < 3 THEN 'TOO EARLY — need more candles' "
    "WHEN current_prob > 0.65 THEN 'YES' WHEN current_prob < 0.35 THEN 'NO' ELSE 'UNCERTAIN' END", "sm"))
def stream_score(spark, sf_dir):
    """L3: candles land in three time slices; each micro-batch rescores the markets it touched."""
    flat = fixtures.candle_flat(spark, sf_dir)
    landing, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    scores, ck = scratch_path(spark, "scores"), scratch_path(spark, "scores-ck")
    cuts = ["2024-01-10", "2024-01-20"]
    ds = F.col("ds")
    slices = [ds < F.lit(cuts[0]).cast("timestamp"),
              (ds >= F.lit(cuts[0]).cast("timestamp")) & (ds < F.lit(cuts[1]).cast("timestamp")),
              ds >= F.lit(cuts[1]).cast("timestamp")]
    for i, cond in enumerate(slices):
        flat.where(cond).write.mode("append").parquet(f"{landing}/slice={i}")
    schema = spark.read.parquet(landing).drop("slice").schema
    scoring.run_stream_scoring(spark, f"{landing}/*", store, scores, ck, live_score, schema)
    return scoring.latest_scores(spark, scores).select("market_id", "current_prob", "candles_seen", "signal")
