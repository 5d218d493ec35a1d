"""Queries for splits (G*), evaluation (E*) and scoring (I*).

Evaluation runs on the model rows with the model-free surrogate score (0.6 / 0.4 blend of
ask close and mean price), so every value has an exact SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.config import DEFAULT_CONFIG
from candlewick.operators import evaluation as E
from candlewick.operators import scoring as S
from candlewick.operators import splits as G
from candlewick.operators import candles as C
from candlewick.operators import features as FE
from candlewick.plans import flows
from candlewick.plans.oracle import (
    clipped_cte, features_cte, final_select, metrics_sql, round_half_up, with_ctes,
)
from candlewick.plans.registry import query
from candlewick.sources import fixtures

THRESHOLD = DEFAULT_CONFIG.backtest_threshold


# Columns the split / evaluation queries read; a written table blocks Catalyst's pruning,
# so the model rows are narrowed before they are materialised.
EVAL_COLS = ["market_id", "series_id", "ds", "label", "close", "ask_close", "price_mean", "hours_to_expiry"]


def _split(spark, sf_dir, cols=EVAL_COLS):
    return G.group_split(flows.materialised(flows.model_frame(spark, sf_dir).select(*cols)), pin=True)


def _scored(spark, sf_dir):
    return flows.surrogate_prob(_split(spark, sf_dir))


def _test(spark, sf_dir):
    return _scored(spark, sf_dir).where(F.col("split") == "test")


@query("group_split", with_ctes("split") + final_select("market_id, series_id, ds:t, split", "splitted"))
def group_split(spark, sf_dir):
    """G1: 70/15/15 by series, groups ranked by md5(seed:series)."""
    return _split(spark, sf_dir).select("market_id", "series_id", "ds", "split")


@query("split_summary", with_ctes("split") + final_select(
    "split, rows:i, markets:i, series:i, pct_rows:d",
    "(SELECT split, rows, markets, series, rows / sum(rows) OVER () * 100.0 AS pct_rows FROM ("
    "SELECT split, count(*) AS rows, count(DISTINCT market_id) AS markets, count(DISTINCT series_id) AS series "
    "FROM splitted GROUP BY split))"))
def split_summary(spark, sf_dir):
    """G2."""
    return G.split_summary(_split(spark, sf_dir))


_FOLDS = ("(SELECT series_id, n_rows, CASE WHEN r % 10 < 5 THEN r % 10 ELSE 9 - r % 10 END AS fold FROM ("
          "SELECT series_id, n_rows, row_number() OVER (ORDER BY n_rows DESC, series_id) - 1 AS r FROM ("
          "SELECT series_id, count(*) AS n_rows FROM splitted WHERE split IN ('train', 'val') GROUP BY series_id)))")


@query("group_folds", with_ctes("split") + final_select("series_id, n_rows:i, fold:i", _FOLDS))
def group_folds(spark, sf_dir):
    """Five folds of the dev set, largest series dealt first in snake order."""
    return G.assign_folds(G.dev_union(_split(spark, sf_dir)), "series_id", DEFAULT_CONFIG.n_folds)


@query("dev_union", with_ctes("split") + final_select("market_id, ds:t, split", "splitted", "split IN ('train', 'val')"))
def dev_union(spark, sf_dir):
    """Train and val rows."""
    return G.dev_union(_split(spark, sf_dir)).select("market_id", "ds", "split")


for _m in ("log_loss", "brier", "auc"):
    def _make(metric):
        @query(f"metric_{metric}", with_ctes("split") + final_select(f"n:i, {metric}:d", metrics_sql("test")))
        def fn(spark, sf_dir):
            form = E.metrics if metric == "auc" else E.log_loss_brier
            return form(_test(spark, sf_dir)).select("n", metric)
        fn.__doc__ = f"E1: {metric} of the surrogate score on the test split."
    _make(_m)

_BASE_SPEC = "model, n:i, log_loss:d, auc:d, brier:d"


@query("baseline_constant", with_ctes(
    "split", "ct AS (SELECT *, (SELECT avg(label) FROM scored WHERE split = 'train') AS p_constant FROM test)")
    + final_select(_BASE_SPEC, f"(SELECT 'Constant prior' AS model, * FROM {metrics_sql('ct', 'p_constant')})"))
def baseline_constant(spark, sf_dir):
    """The training YES rate as a constant score, evaluated on test."""
    sc = _scored(spark, sf_dir)
    return E.baselines(sc.where("split = 'train'"), sc.where("split = 'test'"), names=(E.CONSTANT,))


@query("baseline_market_price", with_ctes(
    "split", "mt AS (SELECT *, least(greatest(close, 0.01), 0.99) AS p_market FROM test)")
    + final_select(_BASE_SPEC, f"(SELECT 'Market price' AS model, * FROM {metrics_sql('mt', 'p_market')})"))
def baseline_market_price(spark, sf_dir):
    """The candle close clipped to [.01, .99] as the score, evaluated on test."""
    sc = _scored(spark, sf_dir)
    return E.baselines(sc.where("split = 'train'"), sc.where("split = 'test'"), names=(E.MARKET,))


_PNL = (f"CASE WHEN prob > {THRESHOLD} THEN (CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END) - close "
        f"WHEN prob < 1 - {THRESHOLD}::double THEN (CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END) - (1 - close) ELSE 0.0 END")
_BETS = f"bets AS (SELECT *, {_PNL} AS pnl FROM test)"


@query("backtest_pnl", with_ctes("split", _BETS) + final_select(
    "market_id, ds:t, prob:d, close:d, label:d, pnl:d, cum_pnl:d",
    "(SELECT *, sum(pnl) OVER (ORDER BY market_id, ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pnl FROM bets)"))
def backtest_pnl(spark, sf_dir):
    """Bet PnL per test row at threshold .60 and the running total in (market, time) order."""
    return E.backtest(_test(spark, sf_dir), THRESHOLD).select("market_id", "ds", "prob", "close", "label", "pnl", "cum_pnl")


@query("backtest_summary", with_ctes("split", _BETS) + final_select(
    "total_bets:i, total_pnl:d, hit_rate:d, pnl_per_bet:d, n_signals:i",
    "(SELECT count_if(pnl <> 0) AS total_bets, sum(pnl) AS total_pnl, "
    "coalesce(count_if(pnl <> 0 AND pnl > 0) / nullif(count_if(pnl <> 0), 0), 0.0) AS hit_rate, "
    f"sum(pnl) / greatest(count_if(pnl <> 0), 1) AS pnl_per_bet, count_if(prob > {THRESHOLD} OR prob < 1 - {THRESHOLD}::double) "
    "AS n_signals FROM bets)"))
def backtest_summary(spark, sf_dir):
    """E4."""
    t = _test(spark, sf_dir)
    return E.backtest_summary(t.withColumns({"pnl": E.pnl_col(threshold=THRESHOLD),
                                              "signalled": E.signalled_col(threshold=THRESHOLD)}))


_FLAGS = ("flg AS (SELECT *, abs(prob - label) AS error, cast(prob >= 0.5 AS int) AS pred, "
          "cast(prob >= 0.5 AND label = 0 AS int) AS fp, cast(prob < 0.5 AND label = 1 AS int) AS fn FROM test)")


@query("error_flags", with_ctes("split", _FLAGS) + final_select(
    "false_positives:i, false_negatives:i, mean_abs_error:d, n:i",
    "(SELECT sum(fp) AS false_positives, sum(fn) AS false_negatives, avg(error) AS mean_abs_error, count(*) AS n FROM flg)"))
def error_flags(spark, sf_dir):
    """E5: false positives / negatives at .5 and mean absolute error on test."""
    return E.error_totals(E.error_flags(_test(spark, sf_dir)))


_BUCKET_CASE = ("CASE WHEN hours_to_expiry > 0 AND hours_to_expiry <= 1 THEN '<1h' "
                "WHEN hours_to_expiry > 1 AND hours_to_expiry <= 3 THEN '1-3h' "
                "WHEN hours_to_expiry > 3 AND hours_to_expiry <= 6 THEN '3-6h' "
                "WHEN hours_to_expiry > 6 AND hours_to_expiry <= 12 THEN '6-12h' WHEN hours_to_expiry > 12 THEN '>12h' END")


@query("error_by_expiry_bucket", with_ctes("split", _FLAGS) + final_select(
    "bucket_order:i, bucket, mean_abs_error:d, n:i",
    "(SELECT b.bucket_order, b.bucket, a.mean_abs_error, coalesce(a.n, 0) AS n FROM "
    "(VALUES (0, '<1h'), (1, '1-3h'), (2, '3-6h'), (3, '6-12h'), (4, '>12h')) b(bucket_order, bucket) LEFT JOIN "
    f"(SELECT {_BUCKET_CASE} AS bucket, avg(error) AS mean_abs_error, count(*) AS n FROM flg GROUP BY 1) a "
    "ON a.bucket = b.bucket)"))
def error_by_expiry_bucket(spark, sf_dir):
    """Mean absolute error by right-closed hours-to-expiry bucket (empty buckets kept)."""
    return E.error_by_bucket(E.error_flags(_test(spark, sf_dir)))


@query("error_histograms", with_ctes("split", _FLAGS, "ek AS (SELECT prob, CASE WHEN fp = 1 THEN 'fp' ELSE 'fn' END AS kind FROM flg WHERE fp = 1 OR fn = 1)") + final_select(
    "kind, bin:i, bin_lo:d, bin_hi:d, count:i",
    "(SELECT r.kind, g.bin, CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END + g.bin * CASE WHEN hi = lo THEN 1.0 ELSE hi - lo END / 20 AS bin_lo, "
    "CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END + (g.bin + 1) * CASE WHEN hi = lo THEN 1.0 ELSE hi - lo END / 20 AS bin_hi, "
    "(SELECT count(*) FROM ek WHERE ek.kind = r.kind AND CASE WHEN r.hi = r.lo THEN 10 ELSE least(floor((ek.prob - r.lo) / (r.hi - r.lo) * 20), 19) END = g.bin) "
    "AS count FROM (SELECT kind, min(prob) AS lo, max(prob) AS hi FROM ek GROUP BY kind) r, (SELECT unnest(range(20)) AS bin) g)"))
def error_histograms(spark, sf_dir):
    """20-bin histograms of the score for false positives and false negatives."""
    f = E.error_flags(_test(spark, sf_dir)).where("fp = 1 OR fn = 1") \
        .withColumn("kind", F.when(F.col("fp") == 1, "fp").otherwise("fn"))
    return E.histogram(f, "prob", "kind", 20)


@query("evaluation_table", with_ctes(
    "split", "ct AS (SELECT *, (SELECT avg(label) FROM scored WHERE split = 'train') AS p_constant, "
    "least(greatest(close, 0.01), 0.99) AS p_market FROM test)",
    f"mr AS (SELECT 'Constant prior' AS model, * FROM {metrics_sql('ct', 'p_constant')} "
    f"UNION ALL SELECT 'Market price' AS model, * FROM {metrics_sql('ct', 'p_market')} "
    f"UNION ALL SELECT 'Primary model' AS model, * FROM {metrics_sql('ct', 'least(greatest(coalesce(ask_close, close), 0.01), 0.99)')} "
    f"UNION ALL SELECT 'Ensemble' AS model, * FROM {metrics_sql('ct', 'prob')})")
    + final_select(_BASE_SPEC + ", beats_market_auc:b",
                   "(SELECT *, CASE WHEN model IN ('Primary model', 'Ensemble') THEN auc > max(CASE WHEN model = 'Market price' THEN auc END) "
                   "OVER () END AS beats_market_auc FROM mr)"))
def evaluation_table(spark, sf_dir):
    """Baselines, a primary score and the blended score side by side, with the beats-market verdict."""
    sc = _scored(spark, sf_dir).withColumn("p1", F.least(F.greatest(F.coalesce("ask_close", "close"), F.lit(0.01)), F.lit(0.99)))
    rows = E.baselines(sc.where("split = 'train'"), sc.where("split = 'test'"), extra={"Primary model": "p1", "Ensemble": "prob"})
    return E.evaluation_table(rows).select("model", "n", "log_loss", "auc", "brier", "beats_market_auc")


# ---------------------------------------------------------------- scoring (I*)
_LIVE = ("lprob AS (SELECT *, least(greatest(0.6 * coalesce(ask_close, close) + 0.4 * coalesce(price_mean, close), "
         "0.01), 0.99) AS prob FROM live)")
_SCORE = (f"sm AS (SELECT market_id, arg_max({round_half_up('prob', 4)}, ds) AS current_prob, "
          "arg_max(hours_to_expiry, ds) AS hours_to_expiry, count(*) AS candles_seen, "
          f"list({round_half_up('prob', 4)} ORDER BY ds) AS all_probs FROM lprob GROUP BY market_id)")
_LIVE_CTES = ("flat", clipped_cte("pre_live", "flat"), features_cte("live", "pre_live"), _LIVE, _SCORE)


def _live_scores(spark, sf_dir):
    """Live scoring input: no resolution-candle drop and no expiry filter."""
    f = FE.engineer_features(C.preprocess(fixtures.candle_flat(spark, sf_dir)))
    return S.score_markets(flows.surrogate_prob(f))


@query("score_live", with_ctes(*_LIVE_CTES) + final_select(
    "market_id, current_prob:d, hours_to_expiry:d, candles_seen:i, all_probs:a", "sm"))
def score_live(spark, sf_dir):
    """Every market scored at once: latest probability, candle count, per-candle probabilities."""
    return _live_scores(spark, sf_dir)


@query("signal", with_ctes(*_LIVE_CTES) + final_select(
    "market_id, current_prob:d, candles_seen:i, signal=CASE WHEN candles_seen < 3 THEN 'TOO EARLY — need more candles' "
    "WHEN current_prob > 0.65 THEN 'YES' WHEN current_prob < 0.35 THEN 'NO' ELSE 'UNCERTAIN' END", "sm"))
def signal(spark, sf_dir):
    """YES / NO / UNCERTAIN / too early per market."""
    return S.with_signal(_live_scores(spark, sf_dir)).select("market_id", "current_prob", "candles_seen", "signal")


@query("lookback_filter", with_ctes("flat") + final_select(
    "market_id, ds:t, close:d", "flat",
    "ds BETWEEN TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 100 DAY AND TIMESTAMP '2024-01-20 00:00:00'"))
def lookback_filter(spark, sf_dir):
    """Candles of the last 100 days before a given end time."""
    return S.lookback(fixtures.candle_flat(spark, sf_dir), "2024-01-20 00:00:00", 100).select("market_id", "ds", "close")


@query("price_edge_signal", with_ctes("split") + final_select(
    "market_id, ds:t, prob:d, close:d, edge=CASE WHEN prob IS NULL OR close IS NULL THEN NULL "
    "WHEN prob - close > 0.05 THEN 'BUY' WHEN close - prob > 0.05 THEN 'SELL' ELSE 'HOLD' END", "scored"))
def price_edge_signal(spark, sf_dir):
    """I4: BUY / SELL / HOLD from the probability against the candle close."""
    return S.with_edge(_scored(spark, sf_dir)).select("market_id", "ds", "prob", "close", "edge")
