"""Scaling, boosted-tree training and selection.

Training data stays a DataFrame; only per-column scaler statistics, histograms and trees reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.config import BAGGING_FREQ, ENSEMBLE_PRIMARY_WEIGHT, SECONDARY_MODEL, SENTINEL
from candlewick.operators import boosting
from candlewick.operators.boosting import FEATURES, Fitted, Model, Settings
from candlewick.operators.candles import fill_sentinel

MISSING_FEATURES = FEATURES + "_missing"


# ---------------------------------------------------------------- T1 scaler
def fit_scaler(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std of each column after the sentinel fill (one aggregate)."""
    filled = fill_sentinel(train.select(*cols), cols)
    row = filled.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(cols)}


def _scaled(stats: dict[str, tuple[float, float]], fill: bool = True) -> dict[str, Column]:
    out = {}
    for c, (m, s) in stats.items():
        scale = 1.0 if (s is None or s == 0.0 or math.isnan(s)) else s
        x = F.coalesce(F.col(c).cast("double"), F.lit(SENTINEL)) if fill else F.col(c)
        out[c] = (x - F.lit(m if m is not None else 0.0)) / F.lit(scale)
    return out


def scaled_columns(df: DataFrame, stats: dict[str, tuple[float, float]], prefix: str = "z_", fill: bool = True) -> DataFrame:
    """(x - mean) / std beside the originals, as ``z_<name>``; a zero std counts as 1 (constant columns)."""
    return df.withColumns({prefix + c: e for c, e in _scaled(stats, fill).items()})


def vectorise(df: DataFrame, stats: dict[str, tuple[float, float]], cols: list[str], out: str = FEATURES) -> DataFrame:
    """Scaled columns as one array, sentinel for NULL; the column ``<out>_missing`` is the same with its NULLs. No input column changes."""
    filled, kept = _scaled({c: stats[c] for c in cols}), _scaled({c: stats[c] for c in cols}, fill=False)
    return df.drop(out, out + "_missing").withColumns({out: F.array(*[filled[c] for c in cols]),
                                                       out + "_missing": F.array(*[kept[c].cast("double") for c in cols])})


def scaler_table(spark, stats: dict[str, tuple[float, float]]) -> DataFrame:
    return spark.createDataFrame([(c, m, s) for c, (m, s) in stats.items()], "feature string, mean double, std double")


def scaler_from_table(table: DataFrame) -> dict[str, tuple[float, float]]:
    return {r["feature"]: (r["mean"], r["std"]) for r in table.collect()}  # one row per feature


# ---------------------------------------------------------------- T2/T3 boosted trees
def primary_settings(cfg: dict, max_rounds: int, patience: int, seed: int = 42, **more) -> Settings:
    """Leaf-wise trees."""
    return Settings(**{**dict(name="primary", learning_rate=float(cfg.get("learning_rate", 0.05)), l2=float(cfg.get("lambda_l2", 0.0)),
                              max_leaves=int(cfg.get("num_leaves", 31)), min_rows=int(cfg.get("min_data_in_leaf", 20)),
                              feature_fraction=float(cfg.get("feature_fraction", 1.0)), bagging_fraction=float(cfg.get("bagging_fraction", 1.0)),
                              bagging_freq=int(cfg.get("bagging_freq", BAGGING_FREQ)), seed=seed, max_rounds=max_rounds, patience=patience), **more})


def secondary_settings(max_rounds: int, patience: int, seed: int = 43, **more) -> Settings:
    """Depth-wise trees with a learned side for missing values."""
    c = SECONDARY_MODEL
    return Settings(**{**dict(name="secondary", learning_rate=float(c["learning_rate"]), l2=float(c["lambda"]), max_leaves=None,
                              max_depth=int(c["max_depth"]), min_rows=1, min_hessian=1.0, feature_fraction=float(c["colsample_bytree"]),
                              bagging_fraction=float(c["subsample"]), bagging_freq=1, learned_missing=True, seed=seed,
                              max_rounds=max_rounds, patience=patience), **more})


def fit_models(rows: DataFrame, settings: list[Settings], cols: list[str], part: Column, key: Column, label: str = "label",
               features: str = FEATURES) -> list[Fitted]:
    """Models fitted in lockstep, each until its patience runs out; ``features``: FEATURES, or MISSING_FEATURES where NULLs count."""
    return boosting.fit(rows, settings, cols, part, key, label, features=features)


def predict_prob(model: Model, df: DataFrame, out: str = "prob") -> DataFrame:
    return boosting.with_probability(model, df, out)


def auc_curve(model: Model, df: DataFrame, rounds: list[int] | None = None, label: str = "label") -> DataFrame:
    """T7 companion: log-loss, Brier and AUC per boosting round on ``df`` (one grouped pass)."""
    from candlewick.operators.evaluation import metrics
    return metrics(boosting.round_probabilities(model, df, rounds), "prob", label, by=["round"])


# ---------------------------------------------------------------- T4 ensemble
def ensemble(df: DataFrame, p1: str = "p1", p2: str = "p2", w: float = ENSEMBLE_PRIMARY_WEIGHT,
             out: str = "prob") -> DataFrame:
    return df.withColumn(out, F.lit(w) * F.col(p1) + F.lit(1 - w) * F.col(p2))


# ---------------------------------------------------------------- T6 summary, T8, T9
def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Per config: mean / population std of validation loss, mean train loss, gap, AUC, Brier,
    best round; ``is_best`` marks the lowest mean validation loss (ties: config name)."""
    s = fold_metrics.groupBy("config").agg(
        F.avg("val_loss").alias("mean_val_loss"), F.stddev_pop("val_loss").alias("std_val_loss"),
        F.avg("train_loss").alias("mean_train_loss"), F.avg(F.col("val_loss") - F.col("train_loss")).alias("mean_gap"),
        F.avg("auc").alias("mean_auc"), F.avg("brier").alias("mean_brier"),
        F.avg("best_iter").alias("mean_best_iter"), F.count(F.lit(1)).alias("n_folds"))
    from pyspark.sql import Window
    best = F.min_by(F.col("config"), F.struct("mean_val_loss", "config")).over(Window.partitionBy())  # one row per config
    return s.withColumn("is_best", F.col("config") == best)


def importance_table(spark, model: Model, cols: list[str]) -> DataFrame:
    """Gain importance per feature: its splits' summed gain, as a share of all."""
    gains = model.gains()
    total = float(gains.sum())
    return spark.createDataFrame([(c, float(x) / total if total else 0.0) for c, x in zip(cols, gains, strict=True)],
                                 "feature string, importance double")


def top_k(imp: DataFrame, k: int = 20) -> DataFrame:
    return imp.orderBy(F.desc("importance"), "feature").limit(k)


def select_features(imp: DataFrame, threshold: float = 0.001) -> DataFrame:
    """Share of total importance; kept when the share reaches ``threshold``."""
    from pyspark.sql import Window
    total = F.sum("importance").over(Window.partitionBy())  # one row per feature
    return imp.withColumn("pct", F.col("importance") / (total + 1e-9)).withColumn("kept", F.col("pct") >= threshold)
