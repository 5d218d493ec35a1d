"""Evaluation and split operators: brute-force checks and properties."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from candlewick.operators import evaluation as E
from candlewick.operators import splits as G
from candlewick.operators.ordered import running_sums


def brute_auc(pairs):
    pos = [p for p, y in pairs if y == 1]
    neg = [p for p, y in pairs if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [0, 1])
def test_auc_equals_pairwise_count_with_ties(spark, seed):
    rng = random.Random(seed)
    pairs = [(round(rng.random(), 1), float(rng.randint(0, 1))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "prob double, label double")
    m = E.metrics(df).first()
    assert m["auc"] == pytest.approx(brute_auc(pairs), abs=1e-12)
    eps = 2.220446049250313e-16
    ll = -sum(y * math.log(min(max(p, eps), 1 - eps)) + (1 - y) * math.log(1 - min(max(p, eps), 1 - eps))
              for p, y in pairs) / len(pairs)
    assert m["log_loss"] == pytest.approx(ll)
    assert m["brier"] == pytest.approx(sum((p - y) ** 2 for p, y in pairs) / len(pairs))


def test_grouped_metrics_equal_separate_ones(spark):
    rng = random.Random(5)
    rows = [(g, round(rng.random(), 2), float(rng.randint(0, 1))) for g in ("a", "b", "c") for _ in range(80)]
    df = spark.createDataFrame(rows, "g string, prob double, label double")
    by = {r.g: r.auc for r in E.metrics(df, by=["g"]).collect()}
    for g in "abc":
        assert by[g] == pytest.approx(brute_auc([(p, y) for gg, p, y in rows if gg == g]), abs=1e-12)


def test_rows_without_score_or_label_are_left_out_and_counted(spark):
    rows = [(0.9, 1.0), (0.1, 0.0), (None, 1.0), (None, 0.0), (0.5, None)]
    df = spark.createDataFrame(rows, "prob double, label double")
    m, q = E.metrics(df).first(), E.log_loss_brier(df).first()
    assert (m["n"], m["auc"]) == (2, 1.0) and m["brier"] == pytest.approx(0.01)
    assert (q["n"], q["n_missing"]) == (2, 3) and q["log_loss"] == pytest.approx(-math.log(0.9)) == pytest.approx(m["log_loss"])


def test_log_loss_needs_one_shuffle_and_no_write(spark):
    df = spark.range(100).selectExpr("id / 100 AS prob", "cast(id % 2 AS double) AS label")
    plan = E.log_loss_brier(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "parquet" not in plan.lower()


def test_backtest_order_is_total_when_times_repeat(spark):
    rows = [("A", 1, 0, 0.9, 0.5, 1.0), ("A", 1, 1, 0.1, 0.5, 1.0), ("A", 1, 2, 0.8, 0.2, 0.0)]
    schema = "market_id string, ds long, pos int, prob double, close double, label double"
    runs = [[(r.pos, round(r.cum_pnl, 9)) for r in E.backtest(spark.createDataFrame(x, schema)).orderBy("pos").collect()]
            for x in (rows, rows[::-1])]
    assert runs[0] == runs[1]


def test_constant_score_auc_half(spark):
    df = spark.createDataFrame([(0.3, float(i % 2)) for i in range(20)], "prob double, label double")
    assert E.metrics(df).first()["auc"] == 0.5


def test_running_sums_match_cumsum(spark):
    rng = random.Random(3)
    rows = [(f"m{rng.randint(0, 30):02d}", i, rng.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "market_id string, ds long, v double")
    got = running_sums(df, ["market_id", "ds"], {"cum": F.col("v")}, num_partitions=7).orderBy("market_id", "ds").collect()
    want = list(itertools.accumulate(v for _, _, v in sorted(rows)))
    assert [r.cum for r in got] == pytest.approx(want)


def test_running_sums_hot_key_split_across_partitions(spark):
    rows = [("hot", i, 1.0) for i in range(900)] + [(f"k{i}", 0, 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    out = running_sums(df, ["k", "t"], {"c": F.col("v")}, num_partitions=8)
    assert sorted(r.c for r in out.collect()) == [float(i) for i in range(1, 1001)]


def test_backtest_rules(spark):
    rows = [("A", 1, 0.9, 0.4, 1.0), ("A", 2, 0.1, 0.4, 0.0), ("A", 3, 0.5, 0.4, 1.0), ("B", 1, 0.7, 0.8, 0.0)]
    df = spark.createDataFrame(rows, "market_id string, ds long, prob double, close double, label double")
    out = E.backtest(df, 0.6).orderBy("market_id", "ds").collect()
    assert [r.pnl for r in out] == pytest.approx([0.6, 0.4, 0.0, -0.8])
    assert [r.cum_pnl for r in out] == pytest.approx([0.6, 1.0, 1.0, 0.2])
    s = E.backtest_summary(E.backtest(df, 0.6)).first()
    assert (s.total_bets, s.hit_rate, s.n_signals) == (3, pytest.approx(2 / 3), 3)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([("fp", float(x)) for x in range(21)], "kind string, prob double")
    h = {r.bin: r["count"] for r in E.histogram(df, "prob", "kind", 20).collect()}
    assert h[19] == 2 and sum(h.values()) == 21


def test_error_buckets_right_closed(spark):
    df = spark.createDataFrame([(0.0, 0.5), (1.0, 0.5), (3.0, 1.0), (12.5, 0.2)], "hours_to_expiry double, error double")
    got = {r.bucket: (r.mean_abs_error, r.n) for r in E.error_by_bucket(df).collect()}
    assert got == {"<1h": (0.5, 1), "1-3h": (1.0, 1), "3-6h": (None, 0), "6-12h": (None, 0), ">12h": (0.2, 1)}


def _rows(spark, n_series=40):
    rng = random.Random(9)
    rows = [(f"S{s}", f"S{s}-{m}", i) for s in range(n_series) for m in range(rng.randint(1, 3))
            for i in range(rng.randint(1, 20))]
    return spark.createDataFrame(rows, "series_id string, market_id string, i long")


def test_group_split_no_straddle_and_sizes(spark):
    df = G.group_split(_rows(spark))
    per = df.groupBy("series_id").agg(F.countDistinct("split").alias("k")).where("k > 1").count()
    assert per == 0
    counts = {r.split: r.n for r in df.select("series_id", "split").distinct().groupBy("split").count()
              .withColumnRenamed("count", "n").collect()}
    n_test, n_val = G.split_sizes(40)                        # ceil(.15 * 40), ceil(.15 / .85 * 34) in doubles
    assert (n_test, n_val) == (6, 6)
    assert counts == {"test": n_test, "val": n_val, "train": 40 - n_test - n_val}


def test_folds_balanced_and_disjoint(spark):
    df = _rows(spark)
    f = G.assign_folds(df, "series_id", 5).collect()
    sizes = {}
    for r in f:
        sizes[r.fold] = sizes.get(r.fold, 0) + r.n_rows
    assert set(sizes) == set(range(5))
    assert max(sizes.values()) - min(sizes.values()) <= max(r.n_rows for r in f)


def test_split_independent_of_shuffle_partitions(spark):
    a = sorted(tuple(r) for r in G.assign_groups(_rows(spark)).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = sorted(tuple(r) for r in G.assign_groups(_rows(spark)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b


def test_score_markets_with_and_without_history(spark):
    import datetime as dt

    from candlewick.operators import scoring as SC
    t0 = dt.datetime(2024, 1, 1)
    rows = [("A", t0 + dt.timedelta(hours=h), p, 5.0 - h) for h, p in enumerate([0.123449, 0.5, 0.87654])] + \
           [("B", t0, 0.2, 0.0)]
    df = spark.createDataFrame(rows, "market_id string, ds timestamp, prob double, hours_to_expiry double")
    full = {r.market_id: r for r in SC.with_signal(SC.score_markets(df)).collect()}
    assert full["A"].current_prob == 0.8765 and full["A"].candles_seen == 3 and full["A"].signal == "YES"
    assert full["A"].all_probs == [0.1234, 0.5, 0.8765] and full["A"].hours_to_expiry == 3.0
    assert full["B"].signal == "TOO EARLY — need more candles"
    lean = {r.market_id: r for r in SC.score_markets(df, history=False).collect()}
    assert "all_probs" not in lean["A"] and lean["A"].current_prob == 0.8765


def test_group_quantile_equals_percentile_with_a_hot_group(spark):
    from candlewick.operators.ordered import group_quantile
    rng = random.Random(21)
    rows = [("hot", float(rng.randint(0, 50))) for _ in range(3000)] + \
           [(f"g{i}", float(rng.randint(0, 9))) for i in range(40) for _ in range(rng.randint(1, 6))] + \
           [("nulls", None), ("one", 7.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("v", 0.99).alias("p")).collect()}
    got = {r.k: r.quantile for r in group_quantile(df, "k", "v", 0.99).collect()}
    assert set(got) == {k for k, p in want.items() if p is not None}
    for k, p in got.items():
        assert p == pytest.approx(want[k], abs=1e-9), k


def test_md5_bucket_ranks_equal_a_plain_sort(spark):
    import hashlib
    keys = [f"S{i}" for i in range(700)]
    df = spark.createDataFrame([(k,) for k in keys for _ in range(2)], "series_id string")   # duplicates per group
    got = {r.series_id: (r["_r"], r["_n"]) for r in G.hash_ranked_groups(df, "series_id", 42).collect()}
    order = sorted(keys, key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    assert got == {k: (i, len(keys)) for i, k in enumerate(order)}
