"""Queries over market metadata (M*) and the parse functions (P*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.functions import columns as FN
from candlewick.operators import markets as M
from candlewick.plans.oracle import final_select, with_ctes
from candlewick.plans.registry import query
from candlewick.sources import fixtures, nested

KW = fixtures.FIXTURE_KEYWORDS
SAMPLE_SPEC = ("market_id, yes_price:d, no_price:d, last_price_dollars:d, volume_history:a, price_momentum:d, "
               "volume_weighted_price:d, time_to_resolution:d, rag_query, label:d")


def _raw(spark, sf_dir):
    return fixtures.raw_markets(spark, sf_dir)


def _dedup(spark, sf_dir, *cols):
    """The de-duplicated markets with the named columns only."""
    return M.dedupe_last(_raw(spark, sf_dir), cols=cols)


def _qd(spark, sf_dir):
    return M.with_question(_dedup(spark, sf_dir, "rules_primary", "yes_sub_title", "no_sub_title", "associated_markets", "title"),
                           "associated_markets")


def _samples(spark, sf_dir):
    return M.market_samples(_dedup(spark, sf_dir, *M.SAMPLE_INPUT), KW)


@query("union_sources", with_ctes("raw_markets") + final_select("src:i, seq:i, ticker, status", "raw_markets"))
def union_sources(spark, sf_dir):
    """M1: historical then recent market lists."""
    raw = _raw(spark, sf_dir)
    u = M.union_sources(raw.where("src = 0").drop("src"), raw.where("src = 1").drop("src"))
    return u.select("src", "seq", "ticker", "status")


@query("dedupe_last_wins", with_ctes("dedup") + final_select(
    "ticker, src:i, seq:i, status, result, volume_fp, first_src:i, first_seq:i", "dedup"))
def dedupe_last_wins(spark, sf_dir):
    """M2: one row per ticker, last source / last row wins, first position kept."""
    return _dedup(spark, sf_dir, "status", "result", "volume_fp").select("ticker", "src", "seq", "status", "result", "volume_fp", "first_src", "first_seq")


@query("source_counts", with_ctes("raw_markets") + final_select(
    "historical:i, recent:i, unique:i",
    "(SELECT count_if(src = 0) AS historical, count_if(src = 1) AS recent, count(DISTINCT ticker) AS \"unique\" "
    "FROM raw_markets)").replace("AS unique", "AS \"unique\"").replace("cast(unique", "cast(\"unique\""))
def source_counts(spark, sf_dir):
    """M3."""
    return M.source_counts(_raw(spark, sf_dir))


@query("bounded_pull", with_ctes("raw_markets") + final_select(
    "src:i, seq:i, ticker", "(SELECT * FROM raw_markets ORDER BY src, seq LIMIT 100)"))
def bounded_pull(spark, sf_dir):
    """M4: the first 100 markets in arrival order (the top-k of a bounded pull; nothing else reads it)."""
    return M.bounded(_raw(spark, sf_dir), ["src", "seq"], 100).select("src", "seq", "ticker")


@query("filter_valid_markets", with_ctes("qd") + final_select("ticker, status, market_type, result", "qd", "valid"))
def filter_valid_markets(spark, sf_dir):
    """M5."""
    return M.valid_markets(_dedup(spark, sf_dir, "status", "market_type", "mve_collection_ticker", "result")).select("ticker", "status", "market_type", "result")


@query("filter_keywords", with_ctes("qd") + final_select("ticker, question", "qd", "kw"))
def filter_keywords(spark, sf_dir):
    """M6: whole-word keyword match on the question."""
    return M.keyword_filter(_qd(spark, sf_dir), "question", KW).select("ticker", "question")


@query("market_question", with_ctes("qd") + final_select("ticker, question", "qd"))
def market_question(spark, sf_dir):
    """M7."""
    return _qd(spark, sf_dir).select("ticker", "question")


@query("label_from_result", with_ctes("dedup") + final_select(
    "ticker, result, label:d=CASE WHEN result = 'yes' THEN 1.0 ELSE 0.0 END", "dedup"))
def label_from_result(spark, sf_dir):
    """M8."""
    return M.with_label(_dedup(spark, sf_dir, "result")).select("ticker", "result", "label")


@query("build_market_samples", with_ctes("samples") + final_select(SAMPLE_SPEC, "samples"))
def build_market_samples(spark, sf_dir):
    """M9: every valid market with a keyword -> sample rows."""
    return _samples(spark, sf_dir)


@query("label_balance", with_ctes("dedup") + final_select(
    "yes_count:i, no_count:i, yes_ratio:d",
    "(SELECT count_if(result = 'yes') AS yes_count, count_if(result = 'no') AS no_count, "
    "count_if(result = 'yes') / count(*) AS yes_ratio FROM dedup)"))
def label_balance(spark, sf_dir):
    """M10."""
    return M.label_balance(_dedup(spark, sf_dir, "result"))


@query("market_preview", with_ctes("raw_markets") + final_select(
    "title, ticker, status, market_type, yes_price:d=try_cast(yes_ask_dollars AS double), "
    "no_price:d=try_cast(no_ask_dollars AS double), volume:d=try_cast(volume_fp AS double), result, "
    "close_time=coalesce(cast(close_time AS varchar), 'N/A')",
    "(SELECT * FROM raw_markets ORDER BY src, seq LIMIT 10)"))
def market_preview(spark, sf_dir):
    """First ten markets with display defaults."""
    return M.preview(_raw(spark, sf_dir))


@query("life_window", with_ctes("life") + final_select("ticker, start_ts:i, end_ts:i, skip_reason", "lw"))
def life_window(spark, sf_dir):
    """Life window from ISO text times, with the reject reason."""
    return M.life_window(fixtures.market_meta(spark, sf_dir)).select("ticker", "start_ts", "end_ts", "skip_reason")


@query("join_labels", with_ctes("samples") + final_select(
    "ticker, label:d", "(SELECT d.ticker, s.label FROM dedup d LEFT JOIN samples s ON d.ticker = s.market_id)"))
def join_labels(spark, sf_dir):
    """Every market gets its sample label (or NULL)."""
    return M.join_labels(_dedup(spark, sf_dir, "status"), _samples(spark, sf_dir)).select("ticker", "label")


_REC = ("rec AS (SELECT market_id, ds, close FROM flat WHERE cast(regexp_extract(market_id, '^U([0-9]+)', 1) AS int) % 3 = 0 "
        "AND ds >= TIMESTAMP '2024-01-10')")


@query("candle_source_fallback", with_ctes("flat", _REC) + final_select(
    "market_id, ds:t, close:d, source",
    "(SELECT *, 'recent' AS source FROM rec UNION ALL SELECT market_id, ds, close, 'historical' FROM flat "
    "WHERE market_id NOT IN (SELECT market_id FROM rec))"))
def candle_source_fallback(spark, sf_dir):
    """Recent candles where a market has them, historical ones otherwise."""
    flat = fixtures.candle_flat(spark, sf_dir).select("market_id", "ds", "close")
    uid = F.regexp_extract("market_id", r"^U([0-9]+)", 1).cast("int")
    recent = flat.where((uid % 3 == 0) & (F.col("ds") >= F.lit("2024-01-10").cast("timestamp")))
    return M.prefer_source(recent, flat)


@query("candles_from_quotes", with_ctes("flat") + final_select(
    "market_id, series_id, ds:t, end_period_ts:i, close:d=coalesce(ask_close, 0.0), high:d=coalesce(ask_high, 0.0), "
    "low:d=coalesce(ask_low, 0.0)", "flat"))
def candles_from_quotes(spark, sf_dir):
    """Quote candles -> ds, close/high/low from the yes-ask quote (missing -> 0)."""
    return M.candles_from_quotes(fixtures.quotes(spark, sf_dir))


@query("build_all_series", with_ctes("life") + final_select(
    "market_id, series_id, ds:t, end_period_ts:i, close:d, high:d, low:d, label:d",
    "(SELECT f.market_id, f.series_id, f.ds, f.end_period_ts, coalesce(f.ask_close, 0.0) AS close, "
    "coalesce(f.ask_high, 0.0) AS high, coalesce(f.ask_low, 0.0) AS low, mm.label "
    "FROM flat f JOIN lw ON f.market_id = lw.ticker AND lw.skip_reason IS NULL "
    "AND f.end_period_ts BETWEEN lw.start_ts AND lw.end_ts JOIN mm ON mm.market_id = f.market_id)"))
def build_all_series(spark, sf_dir):
    """Life window -> candles inside it -> quote candles -> labels."""
    return M.build_series(fixtures.market_meta(spark, sf_dir), fixtures.quotes(spark, sf_dir))


@query("skip_report", with_ctes("life") + final_select(
    "ticker, skip_reason",
    "(SELECT lw.ticker, coalesce(lw.skip_reason, 'empty') AS skip_reason FROM lw LEFT JOIN "
    "(SELECT DISTINCT f.market_id FROM flat f JOIN lw ON f.market_id = lw.ticker AND lw.skip_reason IS NULL "
    "AND f.end_period_ts BETWEEN lw.start_ts AND lw.end_ts AND f.open_interest % 2 = 0) g ON g.market_id = lw.ticker WHERE g.market_id IS NULL)"))
def skip_report(spark, sf_dir):
    """M16 report: markets without a series and why (candles of even open interest only, so that some are empty)."""
    even = fixtures.candle_flat(spark, sf_dir).where(F.col("open_interest") % 2 == 0).select("market_id", "end_period_ts")
    return M.skip_report(fixtures.market_meta(spark, sf_dir), even)


# ---------------------------------------------------------------- parse (P*)
@query("flatten_candles", with_ctes("flat") + final_select(
    "market_id, series_id, ds:t, close:d, high:d, low:d, label:d, volume:d, open_interest:d, end_period_ts:i, "
    "ask_close:d, ask_high:d, ask_low:d, bid_close:d, bid_high:d, bid_low:d, price_mean:d", "flat"))
def flatten_candles(spark, sf_dir):
    """Nested per-market candle arrays -> one row per candle (17 columns)."""
    nest = nested.nest_candles(fixtures.candle_flat(spark, sf_dir))
    return nested.flatten(nest).select(*nested.FLAT_COLUMNS)


@query("to_float", with_ctes("dedup") + final_select(
    "ticker, yes_price:d=try_cast(yes_ask_dollars AS double), volume:d=try_cast(volume_fp AS double)", "dedup"))
def to_float(spark, sf_dir):
    """Numbers held in text; bad or empty text is missing."""
    return _dedup(spark, sf_dir, "yes_ask_dollars", "volume_fp").select("ticker", FN.to_float("yes_ask_dollars").alias("yes_price"),
                                        FN.to_float("volume_fp").alias("volume"))


@query("default_zero", with_ctes("dedup") + final_select(
    "ticker, volume:d=CASE WHEN volume_fp IS NULL OR volume_fp = '' THEN 0.0 ELSE try_cast(volume_fp AS double) END",
    "dedup"))
def default_zero(spark, sf_dir):
    """``float(x or 0)``."""
    return _dedup(spark, sf_dir, "volume_fp").select("ticker", FN.zero_default("volume_fp").alias("volume"))


@query("series_id", with_ctes("dedup") + final_select(
    "ticker, series_id=regexp_replace(ticker, '-[^-]*$', '')", "dedup"))
def series_id(spark, sf_dir):
    """Ticker minus its last suffix."""
    return _dedup(spark, sf_dir, "status").select("ticker", FN.series_id_col("ticker").alias("series_id"))


@query("series_ticker", with_ctes("dedup") + final_select(
    "ticker, series_ticker=split_part(ticker, '-', 1)", "dedup"))
def series_ticker(spark, sf_dir):
    """P5: text before the first dash."""
    return _dedup(spark, sf_dir, "status").select("ticker", FN.series_ticker_col("ticker").alias("series_ticker"))


@query("iso_to_epoch", with_ctes("life") + final_select(
    "ticker, open_epoch:i=CASE WHEN uid % 11 = 0 THEN NULL ELSE cast(epoch(first_ds) AS bigint) - 3600 END",
    "(SELECT market_id AS ticker, * FROM mm)"))
def iso_to_epoch(spark, sf_dir):
    """ISO-8601 text with ``Z`` -> epoch seconds."""
    meta = fixtures.market_meta(spark, sf_dir)
    return meta.select("ticker", FN.iso_to_unix("open_time").alias("open_epoch"))


@query("epoch_to_ts", with_ctes("flat") + final_select(
    "market_id, end_period_ts:i, ds_text=strftime(make_timestamp(end_period_ts * 1000000), '%Y-%m-%d %H:%M:%S')",
    "flat"))
def epoch_to_ts(spark, sf_dir):
    """Epoch seconds -> timestamp -> text."""
    f = fixtures.candle_flat(spark, sf_dir)
    return f.select("market_id", "end_period_ts", FN.ts_to_string(FN.ts_from_epoch("end_period_ts")).alias("ds_text"))
