"""Evaluation operators (E1-E8).  All take a probability column and a 0/1 label."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.config import EXPIRY_BUCKETS
from candlewick.functions.columns import clip_unit
from candlewick.operators.ordered import running_sums

EPS = sys.float_info.epsilon  # probabilities are clipped to [eps, 1 - eps] for log-loss


def log_loss_col(prob="prob", label="label"):
    p = F.least(F.greatest(F.col(prob), F.lit(EPS)), F.lit(1 - EPS))
    y = F.col(label)
    return -(y * F.log(p) + (1 - y) * F.log(1 - p))


def log_loss_brier(df: DataFrame, prob: str = "prob", label: str = "label", by: list[str] | None = None) -> DataFrame:
    """E1 without the AUC: n, log-loss and Brier of the rows holding a score and a label, and ``n_missing``,
    the rows that lack either.  One map-side combined aggregate per ``by`` group."""
    y = F.col(label)
    ok = F.col(prob).isNotNull() & y.isNotNull()
    out = [F.count_if(ok).alias("n"), F.count_if(~ok).alias("n_missing"), F.avg(F.when(ok, log_loss_col(prob, label))).alias("log_loss"),   # least / greatest skip NULL
           F.avg((F.col(prob) - y) * (F.col(prob) - y)).alias("brier")]
    return df.groupBy(*by).agg(*out) if by else df.agg(*out)


def metrics(df: DataFrame, prob: str = "prob", label: str = "label", by: list[str] | None = None) -> DataFrame:
    """N, log-loss, Brier and exact ROC-AUC (ties count one half), one row per ``by`` group.
    Rows without a score or a label are left out (``log_loss_brier`` counts them).

    Rows are first combined per (group, distinct score) map-side, so a hot score value
    costs nothing; negatives below each score come from the range-partitioned prefix
    sum, and every metric is then a plain sum over the per-score table.
    """
    by = list(by or [])
    y = F.col(label)
    per_score = df.where(F.col(prob).isNotNull() & y.isNotNull()).groupBy(*by, F.col(prob).alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg"),
        F.sum(log_loss_col(prob, label)).alias("_ll"), F.sum((F.col(prob) - y) * (F.col(prob) - y)).alias("_sq"))
    cum = running_sums(per_score, by + ["_s"], {"_cneg": F.col("_neg")})
    below = F.col("_cneg") - F.col("_neg")
    # the running count crosses groups: what precedes a group is its least ``below``
    pairs = F.sum(F.col("_pos") * (below + F.col("_neg") / 2.0)) - F.min(below) * F.sum("_pos")
    return cum.groupBy(*by).agg(
        F.sum("_n").alias("n"),
        (F.sum("_ll") / F.sum("_n")).alias("log_loss"),
        (F.sum("_sq") / F.sum("_n")).alias("brier"),
        F.try_divide(pairs, F.sum("_pos") * F.sum("_neg")).alias("auc"),
    )


def train_rate(train: DataFrame, label: str = "label"):
    """The training YES rate as a scalar subquery (stays inside the plan; no driver round trip)."""
    return train.agg(F.avg(label)).scalar()


def baseline_scores(eval_df: DataFrame, pos_rate) -> DataFrame:
    """E2 inputs: constant prior and market price (close clipped to [.01, .99])."""
    rate = pos_rate if not isinstance(pos_rate, (int, float)) else F.lit(float(pos_rate))
    return eval_df.withColumns({"p_constant": rate, "p_market": clip_unit("close")})


def scored_variants(df: DataFrame, scores: dict[str, str], label: str = "label") -> DataFrame:
    """One row per (input row, named score column): lets one grouped ``metrics`` pass
    evaluate several scores (the row count grows by the fixed number of scores)."""
    names = list(scores)
    pick = None
    for n in names:
        pick = (F.when(F.col("model") == n, F.col(scores[n])) if pick is None
                else pick.when(F.col("model") == n, F.col(scores[n])))
    return df.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("model"), label, *set(scores.values())) \
        .withColumn("score", pick)


CONSTANT, MARKET = "Constant prior", "Market price"


def baselines(train: DataFrame, eval_df: DataFrame, label: str = "label", extra: dict[str, str] | None = None,
              names: tuple[str, ...] = (CONSTANT, MARKET)) -> DataFrame:
    """Metrics of the named baselines on ``eval_df`` (plus any ``extra`` named score columns),
    all in one grouped pass."""
    s = baseline_scores(eval_df, train_rate(train, label) if CONSTANT in names else 0.0)
    known = {CONSTANT: "p_constant", MARKET: "p_market"}
    scores = {**{n: known[n] for n in names}, **(extra or {})}
    return metrics(scored_variants(s, scores, label), "score", label, by=["model"])


def pnl_col(prob="prob", close="close", label="label", threshold: float = 0.60, stake: float = 1.0):
    p, c, y = F.col(prob), F.col(close), F.col(label)
    yes = F.when(y == 1, F.lit(stake)).otherwise(F.lit(0.0)) - c * stake
    no = F.when(y == 0, F.lit(stake)).otherwise(F.lit(0.0)) - (1 - c) * stake
    return F.when(p > threshold, yes).when(p < 1 - threshold, no).otherwise(F.lit(0.0))


def signalled_col(prob="prob", threshold: float = 0.60):
    p = F.col(prob)
    return F.coalesce((p > threshold) | (p < 1 - threshold), F.lit(False)).cast("int")


def backtest(df: DataFrame, threshold: float = 0.60, stake: float = 1.0, order=("market_id", "ds"),
             keep=("prob", "close", "label")) -> DataFrame:
    """Per-row bet PnL and its cumulative sum in (market_id, ds) order (carries ``keep``).

    Candles of one market and time follow by ``pos`` where the table has it, then by the kept
    values, so the order is total up to rows that are equal in every way.
    """
    ties = [c for c in ("pos",) if c in df.columns] + [c for c in keep if c not in order]
    order = (*order, *ties)
    df = df.select(*order)
    bets = df.withColumns({"pnl": pnl_col(threshold=threshold, stake=stake), "signalled": signalled_col(threshold=threshold)})
    return running_sums(bets, list(order), {"cum_pnl": F.col("pnl")})


def backtest_summary(bets: DataFrame) -> DataFrame:
    """Bets placed (pnl <> 0, as the reference counts them), total PnL, hit rate, PnL per bet,
    and ``n_signals``: rows where a bet was signalled, break-even bets included."""
    placed = F.col("pnl") != 0
    n = F.count_if(placed)
    return bets.agg(
        n.alias("total_bets"), F.sum("pnl").alias("total_pnl"),
        F.coalesce(F.try_divide(F.count_if(placed & (F.col("pnl") > 0)), n), F.lit(0.0)).alias("hit_rate"),
        (F.sum("pnl") / F.greatest(n, F.lit(1))).alias("pnl_per_bet"),
        F.sum("signalled").alias("n_signals"),
    )


def error_flags(df: DataFrame, prob: str = "prob", label: str = "label") -> DataFrame:
    """E5 per row: absolute error, prediction at .5, false-positive / false-negative flags."""
    pred = (F.col(prob) >= 0.5).cast("int")
    return df.withColumns({
        "error": F.abs(F.col(prob) - F.col(label)), "pred": pred,
        "fp": ((pred == 1) & (F.col(label) == 0)).cast("int"),
        "fn": ((pred == 0) & (F.col(label) == 1)).cast("int"),
    })


def error_totals(flagged: DataFrame) -> DataFrame:
    """E5 totals."""
    return flagged.agg(F.sum("fp").alias("false_positives"), F.sum("fn").alias("false_negatives"),
                       F.avg("error").alias("mean_abs_error"), F.count(F.lit(1)).alias("n"))


def bucket_col(hours="hours_to_expiry"):
    h = F.col(hours)
    expr = None
    for name, lo, hi in EXPIRY_BUCKETS:
        cond = (h > lo) if hi is None else ((h > lo) & (h <= hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def bucket_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n) for i, (n, _, _) in enumerate(EXPIRY_BUCKETS)], "bucket_order int, bucket string")


def error_by_bucket(flagged: DataFrame) -> DataFrame:
    """Mean absolute error per right-closed hours-to-expiry bucket; empty buckets kept (NULL)."""
    agg = flagged.withColumn("bucket", bucket_col()).where(F.col("bucket").isNotNull()) \
        .groupBy("bucket").agg(F.avg("error").alias("mean_abs_error"), F.count(F.lit(1)).alias("n"))
    return F.broadcast(bucket_table(flagged.sparkSession)).join(agg, "bucket", "left") \
        .select("bucket_order", "bucket", "mean_abs_error", F.coalesce("n", F.lit(0)).alias("n"))


def histogram(df: DataFrame, value: str, by: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max] of ``value`` per ``by`` group, empty bins included; the last
    bin is closed.  The join with the group ranges is left to AQE (one row per group)."""
    rng = df.where(F.col(value).isNotNull()).groupBy(by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(bins // 2)).otherwise(
        F.least(F.floor((F.col(value) - F.col("_lo")) / width * bins), F.lit(bins - 1))).cast("int")
    # one row per distinct value and group crosses the shuffles, not one per input row
    per_value = df.groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    counts = per_value.join(rng, by).withColumn("bin", b).groupBy(by, "bin").agg(F.sum("_n").alias("count"))
    lo = F.when(width == 0, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    step = F.when(width == 0, F.lit(1.0)).otherwise(width) / bins
    every = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(counts, [by, "bin"], "left").select(
        by, "bin", (lo + F.col("bin") * step).alias("bin_lo"), (lo + (F.col("bin") + 1) * step).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).alias("count"))


def evaluation_table(rows: DataFrame, market_name: str = MARKET, model_names: tuple[str, ...] = ("Primary model", "Ensemble")) -> DataFrame:
    """The metric rows plus whether each model's AUC beats the market's."""
    market_auc = F.max(F.when(F.col("model") == market_name, F.col("auc"))).over(Window.partitionBy())  # few rows
    return rows.withColumn("beats_market_auc", F.when(F.col("model").isin(*model_names), F.col("auc") > market_auc))
