import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from candlewick.config import DEFAULT_CONFIG
from candlewick.operators import boosting
from candlewick.operators import models as T
from candlewick.plans import flows, training
from candlewick.plans.catalog import REGISTRY
from candlewick.sources import io

from conftest import SF_SMALL


def test_scaler_population_std_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 0.0), (None, 0.0)], "a double, b double")
    stats = T.fit_scaler(df, ["a", "b"])
    m, s = stats["a"]
    assert m == pytest.approx((1 + 3 - 999) / 3)
    assert stats["b"] == (0.0, 0.0)
    out = T.scaled_columns(df, stats).collect()
    assert out[0].z_b == 0.0 and out[2].z_a == pytest.approx((-999 - m) / s)
    assert [(r.a, r.b) for r in out] == [(1.0, 0.0), (3.0, 0.0), (None, 0.0)]        # the inputs stay
    x = T.vectorise(df, stats, ["a", "b"]).collect()
    assert [r.a for r in x] == [1.0, 3.0, None] and x[2].features[0] == pytest.approx((-999 - m) / s)
    assert x[2].features_missing == [None, 0.0] and x[0].features_missing == x[0].features


def test_ensemble_weights(spark):
    df = spark.createDataFrame([(0.5, 1.0)], "p1 double, p2 double")
    assert T.ensemble(df).first().prob == pytest.approx(0.7)


@pytest.fixture(scope="module")
def small_splits(spark):
    return training.make_splits(flows.model_frame(spark, SF_SMALL))


SMALL = replace(DEFAULT_CONFIG, max_rounds=4, patience=2)


@pytest.fixture(scope="module")
def small_fit(small_splits):
    stats, rows = training.scaled(small_splits)
    return stats, rows, training.fit_primary(rows, small_splits.cols, SMALL, {"num_leaves": 15, "learning_rate": 0.3})


def test_fit_score_save_load(spark, small_splits, small_fit, tmp_dir):
    sp, (stats, rows, fitted) = small_splits, small_fit
    assert 1 <= fitted.best_iter <= 4 and len(fitted.val_curve) == len(fitted.train_curve) <= 4
    p = T.predict_prob(fitted.model, training.in_split(rows, "test"))
    assert p.where((F.col("prob") < 0) | (F.col("prob") > 1)).count() == 0
    path = os.path.join(tmp_dir, "bundle")
    io.save_bundle(spark, path, {"primary": fitted.model}, stats, sp.cols)
    models, stats2, cols2 = io.load_bundle(spark, path)
    assert cols2 == sp.cols and set(stats2) == set(stats)
    for c, (m, sd) in stats.items():
        assert stats2[c][0] == pytest.approx(m) and stats2[c][1] == pytest.approx(sd)
    q = T.predict_prob(models["primary"], T.vectorise(sp.test, stats2, cols2), "p2")
    diff = q.join(p.select("market_id", "ds", "prob"), ["market_id", "ds"]).agg(
        F.max(F.abs(F.col("prob") - F.col("p2")))).first()[0]
    assert diff == 0.0


def test_split_has_no_straddling_series(small_splits):
    rows = small_splits.rows
    assert rows.groupBy("series_id").agg(F.countDistinct("split").alias("k")).where("k > 1").count() == 0


def test_cv_summary_picks_lowest_mean(spark):
    fm = spark.createDataFrame([("a", 0, 0.5, 0.4, 0.6, 0.2, 3), ("a", 1, 0.7, 0.4, 0.6, 0.2, 3),
                                ("b", 0, 0.55, 0.5, 0.6, 0.2, 2), ("b", 1, 0.56, 0.5, 0.6, 0.2, 2)],
                               "config string, fold int, val_loss double, train_loss double, auc double, "
                               "brier double, best_iter int")
    s = {r.config: r for r in T.cv_summary(fm).collect()}
    assert s["b"].is_best and not s["a"].is_best
    assert s["a"].std_val_loss == pytest.approx(0.1)


def test_select_features_threshold(spark):
    imp = spark.createDataFrame([("x", 0.9995), ("y", 0.0005)], "feature string, importance double")
    got = {r.feature: r.kept for r in T.select_features(imp, 0.001).collect()}
    assert got == {"x": True, "y": False}


def test_round_scores_and_curves_match_the_model(small_fit):
    _, rows, fitted = small_fit
    va = training.in_split(rows, "val")
    k = len(fitted.val_curve)
    keyed = va.select("market_id", "ds", "features")
    for i in (1, k):
        got = boosting.round_probabilities(fitted.grown, keyed, [i])
        ref = T.predict_prob(fitted.grown.first(i), keyed).select("market_id", "ds", F.col("prob").alias("ref"))
        assert got.join(ref, ["market_id", "ds"]).agg(F.max(F.abs(F.col("prob") - F.col("ref")))).first()[0] < 1e-12
    curve = {r["round"]: r for r in T.auc_curve(fitted.grown, va.select("label", "features")).collect()}
    assert sorted(curve) == list(range(1, k + 1))
    for i in range(1, k + 1):       # the curve that came with the fit is that of the written scores
        assert curve[i].log_loss == pytest.approx(fitted.val_curve[i - 1], abs=1e-8)


def test_train_pipeline_keeps_unscaled_columns(spark, small_splits, tmp_dir):
    sp = small_splits
    cfg = replace(DEFAULT_CONFIG, max_rounds=3, patience=2, n_folds=2, ablation_rounds=2, ablation_patience=1)
    res = training.train_pipeline(sp, cfg, {"only": {"num_leaves": 4, "learning_rate": 0.3}}, os.path.join(tmp_dir, "b"), with_ablation=False)
    a = {(r.market_id, r.ds): r.close for r in sp.test.select("market_id", "ds", "close").collect()}
    assert a == {(r.market_id, r.ds): r.close for r in res["test_scored"].select("market_id", "ds", "close").collect()}
    assert [r.model for r in res["evaluation"].orderBy("model").collect()] == ["Constant prior", "Ensemble", "Market price", "Primary model"]
    assert res["errors"].first()["n"] == len(a) and res["attribution"].count() == 5
    models, stats, cols = io.load_bundle(spark, res["bundle"])
    flat = flows.fixtures.candle_flat(spark, SF_SMALL)
    live = training.score_with_models(flat, models, stats, cols)
    assert live.where("hours_to_expiry <> 0").count() == 0          # the latest candle is the expiry proxy


@pytest.mark.parametrize("name", ["gbt_primary", "gbt_secondary", "hparam_search_holdout", "hparam_search_cv", "training_curves",
                                  "feature_importance_topk", "train_and_evaluate", "score_live_model", "ablation_table", "attribution_topk",
                                  "preprocessing_evidence", "save_load_model"])
def test_registered_model_queries_fit_with_the_library_setting(spark, small_splits, monkeypatch, name):
    class Seen(Exception):
        pass

    def fit(rows, settings, *args, **kwargs):
        raise Seen({(x.max_rounds, x.patience) for x in settings})
    monkeypatch.setattr(T, "fit_models", fit)
    monkeypatch.setattr(training, "make_splits", lambda *args: small_splits)
    with pytest.raises(Seen) as seen:
        REGISTRY[name].build(spark, SF_SMALL)
    assert seen.value.args == ({(200, 20) if name == "ablation_table" else (500, 30)},)
