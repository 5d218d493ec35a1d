"""Queries over the candle table: flagship, cleaning (C*) and features (F*)."""

from __future__ import annotations

from candlewick.plans import flows
from candlewick.plans.oracle import final_select, with_ctes
from candlewick.plans.registry import query


@query("series_label_momentum", with_ctes("model") + final_select(
    "series_id, n_rows:i, n_markets:i, label_share:d, mean_momentum_1h:d",
    "(SELECT series_id, count(*) AS n_rows, count(DISTINCT market_id) AS n_markets, avg(label) AS label_share, "
    "avg(momentum_1h) AS mean_momentum_1h FROM model GROUP BY series_id)"))
def series_label_momentum(spark, sf_dir):
    """Flagship: events -> candles -> C1 -> C4 -> F1-F9 -> C7 -> C8 -> per-series label share and momentum."""
    return flows.series_summary(flows.model_frame(spark, sf_dir))


# ---------------------------------------------------------------- cleaning (C*)
from candlewick.config import ALL_FEATURE_COLS, FEATURE_GROUPS  # noqa: E402
from candlewick.operators import candles as C  # noqa: E402
from candlewick.operators import features as FE  # noqa: E402
from candlewick.plans.oracle import clipped_cte, features_cte  # noqa: E402
from candlewick.sources import fixtures  # noqa: E402

FLAT_SPEC = ("market_id, series_id, ds:t, close:d, high:d, low:d, label:d, volume:d, open_interest:d, "
             "end_period_ts:i, ask_close:d, ask_high:d, ask_low:d, bid_close:d, bid_high:d, bid_low:d, price_mean:d")
FLAG_SPEC = "price_mean_missing:i, bid_close_missing:i, ask_close_missing:i"
INT_FEATURES = {"is_final_3h", "is_final_1h", "hour_index", "close_is_floor", "close_is_ceiling",
                "price_mean_missing", "bid_close_missing", "ask_close_missing"}


def _spec(cols, keys="market_id, ds:t"):
    return keys + ", " + ", ".join(f"{c}:{'i' if c in INT_FEATURES else 'd'}" for c in cols)


def _flat(spark, sf_dir):
    return fixtures.candle_flat(spark, sf_dir)


def _trimmed(spark, sf_dir):
    return C.drop_last(_flat(spark, sf_dir))


def _feat(spark, sf_dir):
    return flows.feature_frame(spark, sf_dir)


@query("drop_resolution_candle", with_ctes("trimmed") + final_select(FLAT_SPEC, "trimmed"))
def drop_resolution_candle(spark, sf_dir):
    """Drop the last candle of every market."""
    return _trimmed(spark, sf_dir)


@query("resolution_candles_dropped", with_ctes("flat") + final_select(
    "dropped:i", "(SELECT count(DISTINCT market_id) AS dropped FROM flat)"))
def resolution_candles_dropped(spark, sf_dir):
    """C1 report: number of candles dropped (one per market)."""
    return C.dropped_last_count(_flat(spark, sf_dir))


@query("missing_flags", with_ctes("trimmed", clipped_cte("fl", "trimmed", clip=False)) + final_select(
    "market_id, ds:t, " + FLAG_SPEC, "fl"))
def missing_flags(spark, sf_dir):
    """C2."""
    return C.missing_flags(_trimmed(spark, sf_dir)).select("market_id", "ds", *[f"{c}_missing" for c in C.MISSING_FLAG_SOURCES])


@query("clip_p99", with_ctes("pre") + final_select("market_id, ds:t, volume:d, open_interest:d", "pre"))
def clip_p99(spark, sf_dir):
    """Volume and open interest capped at the market's 99th percentile."""
    return C.clip_quantile(_trimmed(spark, sf_dir)).select("market_id", "ds", "volume", "open_interest")


@query("preprocess", with_ctes("pre") + final_select(FLAT_SPEC + ", " + FLAG_SPEC, "pre"))
def preprocess(spark, sf_dir):
    """C4 = C2 + C3."""
    return C.preprocess(_trimmed(spark, sf_dir))


@query("preprocess_no_clip", with_ctes("trimmed", clipped_cte("nc", "trimmed", clip=False)) + final_select(
    FLAT_SPEC + ", " + FLAG_SPEC, "nc"))
def preprocess_no_clip(spark, sf_dir):
    """Flags only."""
    return C.preprocess(_trimmed(spark, sf_dir), clip=False)


@query("preprocess_no_flags", with_ctes("trimmed", clipped_cte("nf", "trimmed", flags=False)) + final_select(
    FLAT_SPEC + ", " + FLAG_SPEC, "nf"))
def preprocess_no_flags(spark, sf_dir):
    """Clip, flags forced to 0."""
    return C.preprocess(_trimmed(spark, sf_dir), flags=False)


@query("filter_min_hours", with_ctes("feat") + final_select(
    "market_id, ds:t, hours_to_expiry:d", "feat", "hours_to_expiry > 6"))
def filter_min_hours(spark, sf_dir):
    """Rows with more than 6 hours to expiry."""
    return C.filter_min_hours(_feat(spark, sf_dir)).select("market_id", "ds", "hours_to_expiry")


@query("drop_unlabelled", with_ctes("feat") + final_select(
    "market_id, ds:t, label:d", "feat", "label IS NOT NULL"))
def drop_unlabelled(spark, sf_dir):
    """C8."""
    return C.drop_unlabelled(_feat(spark, sf_dir)).select("market_id", "ds", "label")


@query("describe_column", with_ctes("feat") + final_select(
    "count:i, mean:d, std:d, min:d, p25:d, p50:d, p75:d, max:d",
    "(SELECT count(hours_to_expiry) AS count, avg(hours_to_expiry) AS mean, stddev_samp(hours_to_expiry) AS std, "
    "min(hours_to_expiry) AS min, quantile_cont(hours_to_expiry, 0.25) AS p25, quantile_cont(hours_to_expiry, 0.5) AS p50, "
    "quantile_cont(hours_to_expiry, 0.75) AS p75, max(hours_to_expiry) AS max FROM feat)"))
def describe_column(spark, sf_dir):
    """Summary of hours_to_expiry with exact quartiles."""
    return C.describe_column(_feat(spark, sf_dir), "hours_to_expiry")


_FILLED = ", ".join(f"coalesce(cast({c} AS double), -999.0) AS {c}" for c in ALL_FEATURE_COLS)


@query("fill_sentinel", with_ctes("model", f"filled AS (SELECT market_id, ds, {_FILLED} FROM model)") + final_select(
    _spec(ALL_FEATURE_COLS).replace(":i", ":d"), "filled"))
def fill_sentinel(spark, sf_dir):
    """NULL -> -999 in all model columns of the model rows."""
    rows = flows.model_frame(spark, sf_dir)
    return C.fill_sentinel(rows, ALL_FEATURE_COLS).select("market_id", "ds", *ALL_FEATURE_COLS)


# ---------------------------------------------------------------- features (F*)
FEATURE_QUERIES = {
    "feat_microstructure": FEATURE_GROUPS["microstructure"],
    "feat_lags": ["close_lag1", "close_lag2"],
    "feat_momentum": FEATURE_GROUPS["momentum"],
    "feat_volume": FEATURE_GROUPS["volume"],
    "feat_time": ["market_end_ts", "hours_to_expiry", "is_final_3h", "is_final_1h", "hour_index"],
    "feat_rolling": FEATURE_GROUPS["rolling"],
    "feat_level": ["close_is_floor", "close_is_ceiling", "first_close", "close_vs_open"],
    "feat_running_std": ["running_std"],
    "ensure_flag_columns": FEATURE_GROUPS["missing_flags"],
}


def _feature_query(name, cols):
    spec = _spec(cols).replace("market_end_ts:d", "market_end_ts:t")

    @query(name, with_ctes("feat") + final_select(spec, "feat"))
    def fn(spark, sf_dir):
        return _feat(spark, sf_dir).select("market_id", "ds", *cols)
    fn.__doc__ = f"{name}: {', '.join(cols)} per candle (after C1 and C4)."
    return fn


for _n, _cols in FEATURE_QUERIES.items():
    _feature_query(_n, _cols)


@query("feature_table", with_ctes("model") + final_select(
    _spec(ALL_FEATURE_COLS, "market_id, series_id, ds:t, label:d"), "model"))
def feature_table(spark, sf_dir):
    """keys + the 38 model columns in registry order, on the model rows."""
    return FE.feature_table(flows.model_frame(spark, sf_dir))


@query("ensure_flag_columns_absent", with_ctes("trimmed", features_cte("ff", "trimmed")) + final_select(
    "market_id, ds:t, " + FLAG_SPEC.replace(":i", ":i=0"), "ff"))
def ensure_flag_columns_absent(spark, sf_dir):
    """F9 when C2 did not run: the flag columns are added as 0."""
    return FE.engineer_features(_trimmed(spark, sf_dir)).select(
        "market_id", "ds", *[f"{c}_missing" for c in C.MISSING_FLAG_SOURCES])


@query("feature_table_chunked", with_ctes("model") + final_select(
    _spec(ALL_FEATURE_COLS, "market_id, series_id, ds:t, label:d"), "model"))
def feature_table_chunked(spark, sf_dir):
    """F10 through the skew-safe block (row chunks of 8 with halos, 24-hour time chunks):
    every task is bounded however many candles one market holds; equal to ``feature_table``."""
    from candlewick.operators.chunked import prepared_chunked
    block = prepared_chunked(fixtures.candle_flat(spark, sf_dir), row_chunk=8, time_chunk_hours=24)
    return FE.feature_table(flows.model_rows(block))
