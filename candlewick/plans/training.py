"""The training flow (T5-T10, E9-E11): materialise once, split once, then fit models in lockstep.

The model rows are written once to the shared checkpoint folder and the split / fold
assignments (one row per series) once more; every fit reads those tables, so the
feature windows run a single time.  Configs, folds and ablation variants are models of one
lockstep fit (``operators/boosting.py``); only histograms, trees and metric numbers reach the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.config import DEFAULT_CONFIG, FEATURE_GROUPS, HYPERPARAM_CONFIGS, PRIMARY_MODEL, PipelineConfig
from candlewick.operators import evaluation as E
from candlewick.operators import features as FE
from candlewick.operators import models as T
from candlewick.operators import shapley as SH
from candlewick.operators import splits as G
from candlewick.session import write_and_read


@dataclass
class Splits:
    rows: DataFrame
    train: DataFrame
    val: DataFrame
    test: DataFrame
    cols: list[str]


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage into a parquet table in the shared checkpoint folder (survives executor loss)."""
    return write_and_read(df, "training")


def make_splits(model_rows: DataFrame, cfg: PipelineConfig = DEFAULT_CONFIG) -> Splits:
    cols = FE.feature_columns(model_rows)
    keep = ["market_id", "series_id", "ds", "label", "close", "hours_to_expiry"] + [c for c in cols if c not in (
        "close", "hours_to_expiry")]
    rows = materialise(model_rows.select(*keep))  # the feature windows run once
    rows = G.group_split(rows, "series_id", cfg.train_ratio, cfg.val_ratio, cfg.test_ratio, cfg.seed, pin=True)
    return Splits(rows, rows.where("split = 'train'"), rows.where("split = 'val'"), rows.where("split = 'test'"), cols)


def scaled(sp: Splits, cols: list[str] | None = None, scale: bool = True) -> tuple[dict, DataFrame]:
    """(scaler fitted on train, all rows with their feature arrays; columns stay as they are)."""
    cols = cols or sp.cols
    stats = T.fit_scaler(sp.train, cols) if scale else {c: (0.0, 1.0) for c in cols}
    return stats, T.vectorise(sp.rows, stats, cols)


TRAIN, VAL = 0, 1       # part numbers of a split's fit
FIT_PARALLELISM = 5     # independent fits submitted as concurrent Spark jobs


def split_part() -> Column:
    """Part number of the split; test rows take no part in a fit."""
    return F.when(F.col("split") == "train", TRAIN).when(F.col("split") == "val", VAL)


def row_key() -> Column:
    """What row sampling hashes: a row's market and time."""
    return F.xxhash64("market_id", "ds")


def run_parallel(fn, items, workers: int = FIT_PARALLELISM) -> list:
    """Apply ``fn`` to ``items`` from a small thread pool (Spark schedules jobs from several
    threads side by side); results keep the order of ``items``."""
    if workers <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(fn, items))


KEYS = ["market_id", "series_id", "ds", "label", "close", "hours_to_expiry"]


def written_scores(scored: DataFrame, *cols: str) -> DataFrame:
    """The scores as a table in the shared folder (keys and the named columns), read from there afterwards."""
    return write_and_read(scored.select(*KEYS, *cols), "scores")


def fit_split(rows: DataFrame, settings: list, cols: list[str], features: str = T.FEATURES) -> list:
    """Models fitted in lockstep on the split's train rows, stopped on its val rows."""
    return T.fit_models(rows, settings, cols, split_part(), row_key(), features=features)


def fit_primary(rows: DataFrame, cols: list[str], cfg: PipelineConfig = DEFAULT_CONFIG, model_cfg: dict = PRIMARY_MODEL):
    """T2 on a split."""
    return fit_split(rows, [T.primary_settings(model_cfg, cfg.max_rounds, cfg.patience, cfg.seed)], cols)[0]


def fit_secondary(rows: DataFrame, cols: list[str], cfg: PipelineConfig = DEFAULT_CONFIG):
    """T3 on a split, NULLs kept."""
    return fit_split(rows, [T.secondary_settings(cfg.max_rounds, cfg.patience, cfg.seed + 1)], cols, T.MISSING_FEATURES)[0]


def in_split(rows: DataFrame, split: str) -> DataFrame:
    return rows.where(F.col("split") == split)


def search_holdout(sp: Splits, cfg: PipelineConfig = DEFAULT_CONFIG, configs=None, curves: bool = False) -> list[dict]:
    """T5: each config trained on train (in lockstep), early-stopped and scored on val; lowest log-loss is best.
    The losses per round come with the fit; with ``curves`` (T7) also AUC on val per round."""
    configs = configs or HYPERPARAM_CONFIGS
    _, rows = scaled(sp)
    va = in_split(rows, "val")
    fits = fit_split(rows, [T.primary_settings(c, cfg.max_rounds, cfg.patience, cfg.seed, name=n) for n, c in configs.items()], sp.cols)

    def one(fitted):
        m = E.metrics(written_scores(T.predict_prob(fitted.model, va), "prob")).first()
        out = dict(config=fitted.settings.name, log_loss=m["log_loss"], auc=m["auc"], brier=m["brier"], best_iter=fitted.best_iter,
                   rounds=len(fitted.val_curve), val_curve=fitted.val_curve, train_curve=fitted.train_curve)
        if curves:
            out["by_round"] = write_and_read(T.auc_curve(fitted.grown, va.select("label", T.FEATURES)), "auc-curve")
        return out
    res = run_parallel(one, fits)
    best = min(res, key=lambda r: (r["log_loss"], r["config"]))["config"]
    return [{**r, "is_best": r["config"] == best} for r in res]


def search_cv(sp: Splits, cfg: PipelineConfig = DEFAULT_CONFIG, configs=None) -> list[dict]:
    """Configs x group folds of train+val, all models in one lockstep fit; each row is scored by the models of
    its own fold.  The first fold of each config also keeps its loss curves.  Trees do not depend on a column's
    scale, so no scaler is fitted per fold; the bins are those of all dev rows (their features, not labels)."""
    configs = configs or HYPERPARAM_CONFIGS
    dev = G.group_folds(G.dev_union(sp.rows), "series_id", cfg.n_folds, pin=True)
    rows = T.vectorise(dev, {c: (0.0, 1.0) for c in sp.cols}, sp.cols)
    folds = range(cfg.n_folds)
    fits = T.fit_models(rows, [T.primary_settings(c, cfg.max_rounds, cfg.patience, cfg.seed, name=n, val=(k,),
                                                  train=tuple(j for j in folds if j != k))
                               for n, c in configs.items() for k in folds], sp.cols, F.col("fold"), row_key())
    per = fold_scores(rows, fits, list(configs))
    got = {(r["config"], r["fold"]): r for r in E.metrics(per, "prob", "label", by=["config", "fold"]).collect()}   # a row per fit
    out = []
    for f in fits:
        k, m = f.settings.val[0], got[f.settings.name, f.settings.val[0]]
        out.append(dict(config=f.settings.name, fold=k, val_loss=m["log_loss"], train_loss=f.train_curve[f.best_iter - 1],
                        auc=m["auc"], brier=m["brier"], best_iter=f.best_iter, n=m["n"],
                        val_curve=f.val_curve if k == 0 else None, train_curve=f.train_curve if k == 0 else None))
    return out


def fold_scores(rows: DataFrame, fits: list, names: list[str]) -> DataFrame:
    """Written scores of every row by each config's model of the row's own fold."""
    by_fold = {}
    for f in fits:
        by_fold.setdefault(f.settings.val[0], {})[f.settings.name] = f.model
    parts = [F.col("fold").alias("fold"), F.col("label").alias("label")]
    scored = None
    for k, models in by_fold.items():
        d = rows.where(F.col("fold") == k).select(*parts, T.FEATURES)
        for i, n in enumerate(names):
            d = T.predict_prob(models[n], d, f"p{i}")
        d = d.drop(T.FEATURES)
        scored = d if scored is None else scored.unionByName(d)
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("config"), F.col(f"p{i}").alias("prob")) for i, n in enumerate(names)]))
    return write_and_read(scored.select("fold", "label", pairs.alias("s")).select("fold", "label", "s.config", "s.prob"), "fold-scores")


CV_COLUMNS = "config string, fold int, val_loss double, train_loss double, auc double, brier double, best_iter int, n long"


def fold_table(spark, rows: list[dict]) -> DataFrame:
    """The fold metrics of ``search_cv`` as a table (one row per config and fold)."""
    names = [c.split()[0] for c in CV_COLUMNS.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], CV_COLUMNS)


def ablation(sp: Splits, cfg: PipelineConfig = DEFAULT_CONFIG, model_cfg: dict = PRIMARY_MODEL) -> list[dict]:
    """Full model, minus each feature group (one lockstep fit, each model with its columns), and without the
    scaler: val log-loss and delta."""
    settings = lambda **more: T.primary_settings(model_cfg, cfg.ablation_rounds, cfg.ablation_patience, cfg.seed, **more)
    variants = [settings(name="Full model (all features + scaler)")]
    for grp, gcols in FEATURE_GROUPS.items():
        kept = tuple(i for i, c in enumerate(sp.cols) if c not in gcols)
        if kept:
            variants.append(settings(name=f"Remove '{grp}'", columns=kept))
    jobs = [(scaled(sp)[1], variants), (scaled(sp, scale=False)[1], [settings(name="No StandardScaler")])]
    fits = [(rows, f) for (rows, _), fs in zip(jobs, run_parallel(lambda j: fit_split(*j, sp.cols), jobs), strict=True) for f in fs]
    loss = lambda x: E.log_loss_brier(written_scores(T.predict_prob(x[1].model, in_split(x[0], "val")), "prob")).first()["log_loss"]
    rows = [dict(ablation=f.settings.name, val_loss=v) for (_, f), v in zip(fits, run_parallel(loss, fits), strict=True)]
    return ablation_delta(rows)


def ablation_delta(rows: list[dict]) -> list[dict]:
    """Loss increase over the full model (the first row), smallest first."""
    base = rows[0]["val_loss"]
    return sorted(({**r, "delta": r["val_loss"] - base} for r in rows), key=lambda r: (r["delta"], r["ablation"]))


def attribution(model, val: DataFrame, cols: list[str], k: int = 5) -> DataFrame:
    """Mean absolute Shapley value (log-odds) of each feature over all rows of ``val``, the ``k`` largest."""
    return SH.mean_absolute(model, val, cols).orderBy(F.desc("importance"), "feature").limit(k)


def score_with_models(candles: DataFrame, models: dict, stats: dict, cols: list[str],
                      weight: float | None = None, history: bool = True) -> DataFrame:
    """I1 + I2 with trained models: C4 -> F1-F9 (no resolution-candle drop) -> saved scaler ->
    primary / secondary ensemble -> one row per market."""
    from candlewick.operators import candles as C
    from candlewick.operators import scoring as SC
    from candlewick.config import ENSEMBLE_PRIMARY_WEIGHT
    x = T.vectorise(FE.engineer_features(C.preprocess(candles)), stats, cols)
    if "secondary" in models:
        x = T.predict_prob(models["secondary"], T.predict_prob(models["primary"], x, "p1"), "p2")
        x = T.ensemble(x, "p1", "p2", ENSEMBLE_PRIMARY_WEIGHT if weight is None else weight)
    else:
        x = T.predict_prob(models["primary"], x)
    return SC.with_signal(SC.score_markets(x, history=history))


def train_pipeline(sp: Splits, cfg: PipelineConfig = DEFAULT_CONFIG, configs=None, bundle: str | None = None,
                   with_ablation: bool = True) -> dict:
    """T10, the whole flow: CV search -> probe model -> feature selection (with the validation loss before it)
    -> final primary and secondary model -> ensemble on test -> baselines and evaluation table -> error
    analysis -> back-test -> attribution -> ablation -> saved bundle.

    Every table is on unscaled columns; ``test_scored`` is written once and read by all that follow.
    """
    spark = sp.rows.sparkSession
    configs = configs or HYPERPARAM_CONFIGS
    cv = search_cv(sp, cfg, configs)
    best = T.cv_summary(fold_table(spark, cv)).where("is_best").first()["config"]
    best_cfg = configs[best]
    probe = fit_primary(scaled(sp)[1], sp.cols, cfg, best_cfg)
    imp = T.importance_table(spark, probe.model, sp.cols)
    kept = T.select_features(imp, cfg.feature_selection_threshold).where("kept")
    selected = [r["feature"] for r in kept.collect()]  # model metadata: at most one row per feature
    selected = [c for c in sp.cols if c in set(selected)] or sp.cols
    stats, rows = scaled(sp, selected)
    va, te = in_split(rows, "val"), in_split(rows, "test")
    m1, m2 = run_parallel(lambda fit: fit(rows, selected, cfg), [lambda *a: fit_primary(*a, best_cfg), fit_secondary])
    test = written_scores(T.ensemble(T.predict_prob(m2.model, T.predict_prob(m1.model, te, "p1"), "p2")), "p1", "p2", "prob")
    table = E.baselines(sp.train, test, extra={"Primary model": "p1", "Ensemble": "prob"})
    flagged = E.error_flags(test)
    out = dict(best_config=best, cv=cv, importance=imp, selected=selected, stats=stats, primary=m1, secondary=m2, test_scored=test,
               val_loss_before_selection=min(probe.val_curve[:probe.best_iter]), val_loss=min(m1.val_curve[:m1.best_iter]),
               evaluation=E.evaluation_table(write_and_read(table, "evaluation")), errors=E.error_totals(flagged),
               errors_by_bucket=E.error_by_bucket(flagged), backtest=E.backtest(test, cfg.backtest_threshold),
               attribution=attribution(m1.model, va, selected))
    if with_ablation:
        out["ablation"] = ablation(Splits(sp.rows, sp.train, sp.val, sp.test, selected), cfg, best_cfg)
    if bundle:
        from candlewick.sources import io
        out["bundle"] = io.save_bundle(spark, bundle, {"primary": m1.model, "secondary": m2.model}, stats, selected)
    return out
