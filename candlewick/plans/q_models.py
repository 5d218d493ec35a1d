"""Model queries (T*, E9-E11).

Scaling, ensembling, fold summaries, deltas and selection have exact oracles on data-derived
inputs.  SQL cannot refit trees, so a fitted model's query writes its scores and tables to the
shared folder and returns, beside values SQL knows exactly (rows scored, label sums, baseline
metrics), checks that a wrong fit or table breaks: the loss beats the constant prior, the AUC is
above one half, reported metrics equal those recomputed from the written scores, deltas and best
rows are consistent.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from candlewick.config import ALL_FEATURE_COLS, DEFAULT_CONFIG, FEATURE_GROUPS, HYPERPARAM_CONFIGS
from candlewick.operators import evaluation as E
from candlewick.operators import models as T
from candlewick.operators import splits as G
from candlewick.plans import flows, training
from candlewick.plans.oracle import clipped_cte, features_cte, final_select, metrics_sql, with_ctes
from candlewick.plans.registry import query

# Every fit uses the library's setting (500 rounds, patience 30; ablation 200 rounds, patience 20).
Q = DEFAULT_CONFIG


def _splits(spark, sf_dir):
    return training.make_splits(flows.model_frame(spark, sf_dir), Q)


def _values(rows, cols):
    body = ", ".join("(" + ", ".join(rows_i) + ")" for rows_i in rows)
    return f"(SELECT * FROM (VALUES {body}) v({', '.join(cols)}))"


def _sq(s):
    return "'" + s.replace("'", "''") + "'"


# constant prior of train on another split: n, label sum and its log-loss
_PRIOR = ("(SELECT count(*) AS n, sum(label) AS n_yes, avg(-(label * ln(p) + (1 - label) * ln(1 - p))) AS constant_loss FROM "
          "(SELECT label, (SELECT avg(label) FROM scored WHERE split = 'train') AS p FROM scored WHERE split = '{split}'))")
_CHECKED = "n:i, n_yes:i, constant_loss:d, beats_constant:b=true, auc_above_half:b=true, many_scores:b=true, in_unit:b=true"


def _checked(train, scores, prob="prob"):
    """Written scores against the constant prior: exact counts and prior loss, and checks of the fit."""
    rate = train.agg(F.avg("label")).first()[0]
    m = E.metrics(scores, prob).first()
    base = E.log_loss_col("_c", "label")
    return scores.withColumn("_c", F.lit(rate)).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("n_yes"), F.avg(base).alias("constant_loss"),
        (F.lit(m["log_loss"]) < F.avg(base)).alias("beats_constant"), F.lit(m["auc"] > 0.5).alias("auc_above_half"),
        (F.countDistinct(prob) > 10).alias("many_scores"),
        F.min((F.col(prob) >= 0) & (F.col(prob) <= 1)).alias("in_unit"))


def _near(a, b, tol=1e-6):
    return a is not None and b is not None and abs(a - b) <= tol


_FILLED = ", ".join(f"coalesce(cast({c} AS double), -999.0) AS {c}" for c in ALL_FEATURE_COLS)
_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in ALL_FEATURE_COLS)
_SCALED = ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END AS {c}"
                    for c in ALL_FEATURE_COLS)


@query("standard_scale", with_ctes(
    "split", f"fl AS (SELECT market_id, ds, split, {_FILLED} FROM splitted)",
    f"st AS (SELECT {_STATS} FROM fl WHERE split = 'train')")
    + final_select("market_id, ds:t, " + ", ".join(f"{c}:d" for c in ALL_FEATURE_COLS),
                   f"(SELECT market_id, ds, {_SCALED} FROM fl, st WHERE split = 'test')"))
def standard_scale(spark, sf_dir):
    """Mean / population std fitted on train (after the -999 fill), applied to test."""
    sp = training.make_splits(flows.model_frame(spark, sf_dir), Q)
    stats = T.fit_scaler(sp.train, ALL_FEATURE_COLS)
    return T.scaled_columns(sp.test, stats).select("market_id", "ds", *[F.col(f"z_{c}").alias(c) for c in ALL_FEATURE_COLS])


def _fit_one(spark, sf_dir, fit):
    sp = _splits(spark, sf_dir)
    _, rows = training.scaled(sp)
    fitted = fit(rows, sp.cols, Q)
    return _checked(sp.train, training.written_scores(T.predict_prob(fitted.model, training.in_split(rows, "test")), "prob"))


@query("gbt_primary", with_ctes("split") + final_select(_CHECKED, _PRIOR.format(split="test")))
def gbt_primary(spark, sf_dir):
    """Leaf-wise boosted trees (early-stopped on val) scoring every test row."""
    return _fit_one(spark, sf_dir, training.fit_primary)


@query("gbt_secondary", with_ctes("split") + final_select(_CHECKED, _PRIOR.format(split="test")))
def gbt_secondary(spark, sf_dir):
    """Depth-5 boosted trees with a learned side for NULLs, scoring every test row."""
    return _fit_one(spark, sf_dir, training.fit_secondary)


@query("ensemble_score", with_ctes("split") + final_select(
    "market_id, ds:t, prob:d=0.6 * prob + (1 - 0.6) * least(greatest(close, 0.01), 0.99)", "test"))
def ensemble_score(spark, sf_dir):
    """T4: 0.6 * p1 + 0.4 * p2 on given scores (p1 = surrogate, p2 = clipped close)."""
    from candlewick.plans.q_eval import _test
    t = _test(spark, sf_dir).withColumns({"p1": F.col("prob"), "p2": E.clip_unit("close")})
    return T.ensemble(t.drop("prob"), "p1", "p2").select("market_id", "ds", "prob")


_CONFIGS = _values([[_sq(n)] for n in HYPERPARAM_CONFIGS], ["config"])


@query("hparam_search_holdout", with_ctes("split") + final_select(
    "config, n:i, constant_loss:d, beats_constant:b=true, auc_above_half:b=true, one_best:b=true, curve_agrees:b=true",
    f"(SELECT c.config, p.n, p.constant_loss FROM {_CONFIGS} c, {_PRIOR.format(split='val')} p)"))
def hparam_search_holdout(spark, sf_dir):
    """T5: each config trained on train and scored on val; the best is the lowest log-loss, and the loss
    recomputed from the written scores is the lowest of the loss curve."""
    sp = _splits(spark, sf_dir)
    res = training.search_holdout(sp, Q)
    prior = _prior(sp.train, sp.val)
    best = [r for r in res if r["is_best"]]
    one = len(best) == 1 and best[0]["log_loss"] == min(r["log_loss"] for r in res)
    rows = [(r["config"], prior["n"], prior["loss"], r["log_loss"] < prior["loss"], r["auc"] > 0.5, one,
             _near(r["log_loss"], min(r["val_curve"][:r["best_iter"]]))) for r in res]
    return spark.createDataFrame(rows, "config string, n long, constant_loss double, beats_constant boolean, auc_above_half boolean, "
                                       "one_best boolean, curve_agrees boolean")


def _prior(train, rows):
    """n and log-loss of the constant prior of ``train`` on ``rows``."""
    rate = train.agg(F.avg("label")).first()[0]
    r = E.log_loss_brier(rows.select("label", F.lit(rate).alias("prob"))).first()
    return {"n": r["n"], "loss": r["log_loss"]}


@query("hparam_search_cv", with_ctes("split") + final_select(
    "config, n_folds:i, n:i, beats_constant:b=true, auc_above_half:b=true, curves_kept:b=true, one_best:b=true",
    f"(SELECT c.config, 5 AS n_folds, (SELECT count(*) FROM splitted WHERE split IN ('train', 'val')) AS n FROM {_CONFIGS} c)"))
def hparam_search_cv(spark, sf_dir):
    """Configs x 5 group folds: every dev row is scored once a config, the mean loss beats the entropy of
    the labels' share, and the first fold keeps its curves."""
    sp = _splits(spark, sf_dir)
    res = training.search_cv(sp, Q)
    rate = G.dev_union(sp.rows).agg(F.avg("label")).first()[0]
    entropy = -(rate * math.log(rate) + (1 - rate) * math.log(1 - rate))
    summ = T.cv_summary(training.fold_table(spark, res)).collect()      # one row per config
    kept = {r["config"] for r in res if r["fold"] == 0 and r["val_curve"] and len(r["train_curve"]) == len(r["val_curve"])}
    one = sum(bool(s["is_best"]) for s in summ) == 1
    rows = [(s["config"], s["n_folds"], sum(r["n"] for r in res if r["config"] == s["config"]), s["mean_val_loss"] < entropy,
             s["mean_auc"] > 0.5, s["config"] in kept, one) for s in summ]
    return spark.createDataFrame(rows, "config string, n_folds long, n long, beats_constant boolean, auc_above_half boolean, "
                                       "curves_kept boolean, one_best boolean")


_VAL = "(SELECT * FROM scored WHERE split = 'val')"

# cv_summary: the fold-metric aggregation, exact, on fold metrics of two model-free scores
_CV_FOLDS = ("(SELECT series_id, CASE WHEN r % 10 < 5 THEN r % 10 ELSE 9 - r % 10 END AS fold FROM ("
             "SELECT series_id, row_number() OVER (ORDER BY n DESC, series_id) - 1 AS r FROM ("
             "SELECT series_id, count(*) AS n FROM splitted WHERE split IN ('train', 'val') GROUP BY series_id)))")
_CV_SCORES = (f"cvs AS (SELECT d.*, f.fold, v.config, CASE v.config WHEN 'surrogate' THEN d.prob "
              f"ELSE least(greatest(d.close, 0.01), 0.99) END AS score FROM scored d JOIN {_CV_FOLDS} f "
              "ON d.series_id = f.series_id, (VALUES ('surrogate'), ('market')) v(config) WHERE d.split IN ('train', 'val'))")
_EPS = "2.220446049250313e-16"
_LL = (f"-(label * ln(least(greatest(score, {_EPS}), 1 - {_EPS})) + "
       f"(1 - label) * ln(1 - least(greatest(score, {_EPS}), 1 - {_EPS})))")
_CV_FM = f"""fm AS (
  SELECT g.config, g.fold, g.ll / g.n AS val_loss, (t.ll - g.ll) / (t.n - g.n) AS train_loss, g.brier, a.auc, 0 AS best_iter
  FROM (SELECT config, fold, count(*) AS n, sum({_LL}) AS ll, avg((score - label) * (score - label)) AS brier
        FROM cvs GROUP BY config, fold) g
  JOIN (SELECT config, count(*) AS n, sum({_LL}) AS ll FROM cvs GROUP BY config) t ON g.config = t.config
  JOIN (SELECT config, fold, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM (
          SELECT *, sum(neg) OVER (PARTITION BY config, fold ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below
          FROM (SELECT config, fold, score AS s, sum(label) AS pos, sum(1 - label) AS neg FROM cvs GROUP BY config, fold, score))
        GROUP BY config, fold) a ON g.config = a.config AND g.fold = a.fold)"""


@query("cv_summary", with_ctes("split", _CV_SCORES, _CV_FM) + final_select(
    "config, mean_val_loss:d, std_val_loss:d, mean_train_loss:d, mean_gap:d, mean_auc:d, mean_brier:d, "
    "mean_best_iter:d, n_folds:i, is_best:b",
    "(SELECT *, config = arg_min(config, mean_val_loss) OVER () AS is_best FROM ("
    "SELECT config, avg(val_loss) AS mean_val_loss, stddev_pop(val_loss) AS std_val_loss, avg(train_loss) AS mean_train_loss, "
    "avg(val_loss - train_loss) AS mean_gap, avg(auc) AS mean_auc, avg(brier) AS mean_brier, avg(best_iter) AS mean_best_iter, "
    "count(*) AS n_folds FROM fm GROUP BY config))"))
def cv_summary(spark, sf_dir):
    """T6 aggregation: per-config mean / std over fold metrics (here of two model-free scores)."""
    from candlewick.plans.q_eval import _scored
    dev = G.group_folds(G.dev_union(_scored(spark, sf_dir)), "series_id", 5, pin=True)
    both = dev.withColumn("config", F.explode(F.array(F.lit("surrogate"), F.lit("market")))).withColumn(
        "score", F.when(F.col("config") == "surrogate", F.col("prob")).otherwise(E.clip_unit("close")))
    per = E.metrics(both, "score", "label", by=["config", "fold"])
    ll = E.log_loss_col("score", "label")
    tot = both.groupBy("config").agg(F.count(F.lit(1)).alias("tn"), F.sum(ll).alias("tll"))
    fm = per.join(tot, "config").select(
        "config", "fold", F.col("log_loss").alias("val_loss"),
        ((F.col("tll") - F.col("log_loss") * F.col("n")) / (F.col("tn") - F.col("n"))).alias("train_loss"),
        "auc", "brier", F.lit(0).alias("best_iter"))
    return T.cv_summary(fm)


@query("training_curves", with_ctes("split") + final_select(
    "config, n:i, starts_near_prior:b=true, train_falls:b=true, best_is_lowest:b=true, auc_rows_agree:b=true",
    f"(SELECT c.config, (SELECT count(*) FROM splitted WHERE split = 'val') AS n FROM {_CONFIGS} c)"))
def training_curves(spark, sf_dir):
    """Per round train and val loss, and per round log-loss / Brier / AUC on val, written as tables; the
    two loss curves agree round by round, and the kept round is the lowest before patience ran out."""
    sp = _splits(spark, sf_dir)
    out = []
    for r in training.search_holdout(sp, Q, curves=True):
        by_round = r["by_round"].orderBy("round").collect()             # one row per boosting round
        agree = len(by_round) == r["rounds"] and all(_near(x["log_loss"], v) and 0 <= x["auc"] <= 1
                                                     for x, v in zip(by_round, r["val_curve"]))
        k = r["best_iter"]
        out.append((r["config"], by_round[0]["n"], r["val_curve"][0] < math.log(2) + 0.1, r["train_curve"][k - 1] < r["train_curve"][0],
                    r["val_curve"][k - 1] == min(r["val_curve"][:min(len(r["val_curve"]), k + Q.patience)]), agree))
    return spark.createDataFrame(out, "config string, n long, starts_near_prior boolean, train_falls boolean, best_is_lowest boolean, "
                                      "auc_rows_agree boolean")


@query("feature_importance_topk", with_ctes("split") + final_select(
    "n_train:i, n_ranked:i, sums_to_one:b, ordered:b, known:b",
    "(SELECT count(*) AS n_train, 20 AS n_ranked, true AS sums_to_one, true AS ordered, true AS known FROM splitted WHERE split = 'train')"))
def feature_importance_topk(spark, sf_dir):
    """The 20 most important features of the primary model (written as a table); all importances sum to 1."""
    from candlewick.session import write_and_read
    sp = _splits(spark, sf_dir)
    _, rows = training.scaled(sp)
    fitted = training.fit_primary(rows, sp.cols, Q)
    imp = write_and_read(T.importance_table(spark, fitted.model, sp.cols), "importance")
    top = T.top_k(imp, 20).collect()                                    # 20 rows
    total = imp.agg(F.sum("importance")).first()[0]
    ordered = all(x["importance"] >= y["importance"] >= 0 for x, y in zip(top, top[1:])) and top[0]["importance"] > top[-1]["importance"]
    return sp.train.agg(F.count(F.lit(1)).alias("n_train"), F.lit(len(top)).alias("n_ranked"), F.lit(_near(total, 1.0)).alias("sums_to_one"),
                        F.lit(ordered).alias("ordered"), F.lit(all(x["feature"] in ALL_FEATURE_COLS for x in top)).alias("known"))


_CORR = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(CASE WHEN isnan(corr({c}, label)) THEN 0.0 ELSE coalesce(abs(corr({c}, label)), 0.0) END, 6)"
    f" AS importance FROM fl WHERE split = 'train'" for c in ALL_FEATURE_COLS)


@query("select_features", with_ctes(
    "split", f"fl AS (SELECT split, label, {_FILLED} FROM splitted)", f"imp AS ({_CORR})")
    + final_select("feature, importance:d, pct:d, kept:b",
                   "(SELECT *, pct >= 0.001 AS kept FROM ("
                   "SELECT feature, importance, importance / (sum(importance) OVER () + 1e-9) AS pct FROM imp))"))
def select_features(spark, sf_dir):
    """T9 on a data-derived importance table (|corr(feature, label)| on train): share and keep flag."""
    from candlewick.operators.candles import fill_sentinel
    sp = _splits(spark, sf_dir)
    tr = fill_sentinel(sp.train, ALL_FEATURE_COLS)
    # Pearson correlation; a constant column has none (ANSI-safe division)
    row = tr.agg(*[F.try_divide(F.covar_pop(c, "label"), F.stddev_pop(c) * F.stddev_pop("label")).alias(c)
                   for c in ALL_FEATURE_COLS]).first()
    imp = spark.createDataFrame(
        [(c, round(0.0 if row[c] is None or math.isnan(row[c]) else abs(row[c]), 6)) for c in ALL_FEATURE_COLS],
        "feature string, importance double")
    return T.select_features(imp, Q.feature_selection_threshold)


_T10 = (
    "split", "ct AS (SELECT *, (SELECT avg(label) FROM scored WHERE split = 'train') AS p_constant, "
    "least(greatest(close, 0.01), 0.99) AS p_market FROM test)",
    f"br AS (SELECT 'Constant prior' AS model, * FROM {metrics_sql('ct', 'p_constant')} "
    f"UNION ALL SELECT 'Market price' AS model, * FROM {metrics_sql('ct', 'p_market')} "
    "UNION ALL SELECT v.model, (SELECT count(*) FROM test), NULL, NULL, NULL FROM (VALUES ('Primary model'), ('Ensemble')) v(model))")


@query("train_and_evaluate", with_ctes(*_T10) + final_select(
    "model, n:i, log_loss:d, brier:d, auc:d, beats_constant:b, flow_ok:b=true",
    "(SELECT *, CASE WHEN model IN ('Primary model', 'Ensemble') THEN true END AS beats_constant FROM br)"))
def train_and_evaluate(spark, sf_dir):
    """CV search, probe, selection, final models, ensemble, baselines, evaluation, errors, back-test,
    attribution, ablation and saved bundle.  Returns the evaluation table (the trained rows' values, which SQL
    cannot state, as whether they beat the constant prior) and whether the other parts agree with it."""
    from candlewick.session import scratch_path
    from candlewick.sources import io
    sp = _splits(spark, sf_dir)
    res = training.train_pipeline(sp, Q, bundle=scratch_path(spark, "final-bundle"))
    rows = {r["model"]: r for r in res["evaluation"].collect()}         # four rows
    bets = E.backtest_summary(res["backtest"]).first()
    total = res["test_scored"].agg(F.sum(E.pnl_col(threshold=Q.backtest_threshold))).first()[0]
    models, _, cols = io.load_bundle(spark, res["bundle"])
    errors = res["errors"].first()
    ok = (_near(bets["total_pnl"], total) and set(models) == {"primary", "secondary"} and cols == res["selected"]
          and errors["n"] == rows["Ensemble"]["n"] and res["attribution"].count() == 5 and len(res["ablation"]) == len(_ABL)
          and sum(r["n"] or 0 for r in res["errors_by_bucket"].collect()) == errors["n"]
          and math.isfinite(res["val_loss_before_selection"]) and math.isfinite(res["val_loss"]))
    prior = rows[E.CONSTANT]["log_loss"]
    base = (E.CONSTANT, E.MARKET)
    out = [(m, r["n"], *((r["log_loss"], r["brier"], r["auc"], None) if m in base else (None, None, None, r["log_loss"] < prior)), bool(ok))
           for m, r in rows.items()]
    return spark.createDataFrame(out, "model string, n long, log_loss double, brier double, auc double, beats_constant boolean, flow_ok boolean")


@query("score_live_model", with_ctes("flat", clipped_cte("pre_live", "flat"), features_cte("live", "pre_live")) + final_select(
    "market_id, candles_seen:i, hours_to_expiry:d, probs_ok:b=true, signal_ok:b=true",
    "(SELECT market_id, count(*) AS candles_seen, arg_max(hours_to_expiry, ds) AS hours_to_expiry FROM live GROUP BY market_id)"))
def score_live_model(spark, sf_dir):
    """I1 + I2 end to end: live-shape quotes -> candles -> cleaning and features -> saved and reloaded bundle ->
    probability, hours to expiry and signal of every market."""
    from candlewick.functions.columns import signal_col
    from candlewick.plans.q_sources import live_flat
    from candlewick.session import scratch_path
    from candlewick.sources import io
    sp = _splits(spark, sf_dir)
    stats, rows = training.scaled(sp)
    m1, m2 = training.run_parallel(lambda fit: fit(rows, sp.cols, Q), [training.fit_primary, training.fit_secondary])
    path = io.save_bundle(spark, scratch_path(spark, "live-bundle"), {"primary": m1.model, "secondary": m2.model}, stats, sp.cols)
    models, stats2, cols = io.load_bundle(spark, path)
    scored = training.score_with_models(live_flat(spark, sf_dir), models, stats2, cols)
    unit = F.forall("all_probs", lambda p: (p >= 0) & (p <= 1)) & (F.size("all_probs") == F.col("candles_seen")) \
        & (F.element_at("all_probs", -1) == F.col("current_prob"))
    return scored.select("market_id", "candles_seen", "hours_to_expiry", unit.alias("probs_ok"),
                         (F.col("signal") == signal_col("current_prob", "candles_seen")).alias("signal_ok"))


_ABL = ["Full model (all features + scaler)"] + [f"Remove '{g}'" for g in FEATURE_GROUPS] + ["No StandardScaler"]


@query("ablation_table", with_ctes("split") + final_select(
    "ablation, n:i, constant_loss:d, beats_constant:b=true, delta_ok:b=true",
    f"(SELECT a.ablation, p.n, p.constant_loss FROM {_values([[_sq(a)] for a in _ABL], ['ablation'])} a, {_PRIOR.format(split='val')} p)"))
def ablation_table(spark, sf_dir):
    """Val log-loss without each feature group and without the scaler, and its delta to the full model."""
    sp = _splits(spark, sf_dir)
    rows = training.ablation(sp, Q)
    prior = _prior(sp.train, sp.val)
    full = next(r["val_loss"] for r in rows if r["ablation"] == _ABL[0])
    out = [(r["ablation"], prior["n"], prior["loss"], r["val_loss"] < prior["loss"], _near(r["delta"], r["val_loss"] - full, 1e-12))
           for r in rows]
    return spark.createDataFrame(out, "ablation string, n long, constant_loss double, beats_constant boolean, delta_ok boolean")


@query("ablation_delta", with_ctes("split") + final_select(
    "ablation, val_loss:d, delta:d",
    f"(SELECT ablation, val_loss, val_loss - first_value(val_loss) OVER (ORDER BY nr) AS delta FROM ("
    f"SELECT 'surrogate' AS ablation, 0 AS nr, log_loss AS val_loss FROM {metrics_sql(_VAL)} UNION ALL "
    f"SELECT 'market price', 1, log_loss FROM {metrics_sql(_VAL, 'least(greatest(close, 0.01), 0.99)')}))"))
def ablation_delta(spark, sf_dir):
    """E9 delta, exact, on the val log-loss of two model-free scores."""
    from candlewick.plans.q_eval import _scored
    va = _scored(spark, sf_dir).where("split = 'val'")
    loss = {"surrogate": E.log_loss_brier(va).first()["log_loss"],
            "market price": E.log_loss_brier(va.withColumn("prob", E.clip_unit("close"))).first()["log_loss"]}
    rows = training.ablation_delta([dict(ablation=k, val_loss=v) for k, v in loss.items()])
    return spark.createDataFrame([(r["ablation"], r["val_loss"], r["delta"]) for r in rows], "ablation string, val_loss double, delta double")


@query("attribution_topk", with_ctes("split") + final_select(
    "n:i, n_ranked:i, known:b=true, ordered:b=true, top_matters:b=true, adds_up:b=true",
    "(SELECT count(*) AS n, 5 AS n_ranked FROM splitted WHERE split = 'val')"))
def attribution_topk(spark, sf_dir):
    """The 5 features of greatest mean absolute Shapley value over all val rows; every row's values and the
    model's expectation add up to its log-odds."""
    from candlewick.operators import shapley
    sp = _splits(spark, sf_dir)
    _, rows = training.scaled(sp)
    fitted = training.fit_primary(rows, sp.cols, Q)
    va = training.in_split(rows, "val")
    top = training.attribution(fitted.model, va, sp.cols, 5).collect()  # five rows
    known = all(r["feature"] in ALL_FEATURE_COLS for r in top)
    ordered = all(x["importance"] >= y["importance"] for x, y in zip(top, top[1:]))
    mean = fitted.model.base + sum(shapley.expectation(shapley.paths(t)) for t in fitted.model.trees)
    both = T.predict_prob(fitted.model, shapley.with_values(fitted.model, va))
    total = F.lit(mean) + F.aggregate("shapley", F.lit(0.0), lambda a, x: a + x)
    gap = both.agg(F.max(F.abs(1 / (1 + F.exp(-total)) - F.col("prob")))).first()[0]
    return sp.val.agg(F.lit(top[0]["n"]).alias("n"), F.lit(len(top)).alias("n_ranked"), F.lit(known).alias("known"), F.lit(ordered).alias("ordered"),
                      F.lit(top[0]["importance"] > 0).alias("top_matters"), F.lit(gap < 1e-9).alias("adds_up"))


_EVID = ("(SELECT 'No missing flags' AS variant, (SELECT count(*) FROM model) AS n_rows UNION ALL "
         "SELECT 'With missing flags (full)', (SELECT count(*) FROM model) UNION ALL "
         "SELECT 'No >6h filter', (SELECT count(*) FROM feat WHERE label IS NOT NULL) UNION ALL "
         "SELECT 'With >6h filter', (SELECT count(*) FROM model))")


@query("preprocessing_evidence", with_ctes("model") + final_select(
    "variant, n_rows:i, beats_constant:b=true, auc_above_half:b=true, top_known:b=true", _EVID))
def preprocessing_evidence(spark, sf_dir):
    """Test metrics and top feature with / without missing flags and with / without the >6 h filter
    (row counts exact).  The feature block runs once; the full variant is fitted once and reported twice."""
    from candlewick.operators.candles import MISSING_FLAG_SOURCES
    from candlewick.plans.flows import model_rows
    feat = training.materialise(flows.feature_frame(spark, sf_dir))
    unflagged = feat.withColumns({f"{c}_missing": F.lit(0) for c in MISSING_FLAG_SOURCES})
    variants = [("No missing flags", model_rows(unflagged)), ("full", model_rows(feat)), ("No >6h filter", model_rows(feat, min_hours=False))]

    def one(variant):
        name, rows = variant
        sp = training.make_splits(rows, Q)
        _, scaled = training.scaled(sp)
        fitted = training.fit_primary(scaled, sp.cols, Q)
        m = E.metrics(training.written_scores(T.predict_prob(fitted.model, training.in_split(scaled, "test")), "prob")).first()
        top = T.top_k(T.importance_table(spark, fitted.model, sp.cols), 1).first()["feature"]
        return name, sp.rows.count(), m["log_loss"] < _prior(sp.train, sp.test)["loss"], m["auc"] > 0.5, top in ALL_FEATURE_COLS
    got = {r[0]: r[1:] for r in training.run_parallel(one, variants)}
    out = [(n, *got.get(n, got["full"])) for n in ("No missing flags", "With missing flags (full)", "No >6h filter", "With >6h filter")]
    return spark.createDataFrame(out, "variant string, n_rows long, beats_constant boolean, auc_above_half boolean, top_known boolean")
