"""Streaming pieces that the oracle test does not reach directly: several micro-batches, any order, replays."""

import os

from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.operators import features as FE
from candlewick.plans import flows
from candlewick.plans.q_sources import live_score
from candlewick.sources import fixtures
from candlewick.sources.tables import table
from candlewick.streaming import bars, dedupe, scoring

from conftest import SF_SMALL


def _ticks(spark, folder, n=4, newest_first=True):
    """The events in ``n`` files, one per time slice, landed newest first."""
    events = table(spark, SF_SMALL, "events")
    cut = events.withColumn("part", F.ntile(n).over(__import__("pyspark").sql.Window.orderBy("ts")))
    for i in (range(n, 0, -1) if newest_first else range(1, n + 1)):
        cut.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(folder)
    return events


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


COLS = ["market_id", "ds", "open", "high", "low", "close", "mean_px", "volume", "n_ticks"]


def test_bar_stream_out_of_order_equals_batch(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    events = _ticks(spark, src)
    bars.stream_bars(spark, src, out, ck, max_files=1)
    assert len([d for d in os.listdir(out) if d.startswith("batch_id=")]) >= 4
    assert _rows(bars.merged_bars(spark, out).select(COLS)) == _rows(bars.hourly_bars(events).select(COLS))
    events.limit(50).coalesce(1).write.mode("append").parquet(src)          # a restart goes on where it stopped
    bars.stream_bars(spark, src, out, ck, max_files=1)
    want = bars.hourly_bars(events.unionByName(events.limit(50)))
    assert bars.merged_bars(spark, out).agg(F.sum("n_ticks")).first()[0] == want.agg(F.sum("n_ticks")).first()[0]


def test_replayed_bar_batch_is_not_counted_twice(spark, tmp_dir):
    out = os.path.join(tmp_dir, "bars")
    land, events = bars.batch_lander(out), table(spark, SF_SMALL, "events")
    half = events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")
    for batch, i in ((half[0], 0), (half[1], 1), (half[1], 1)):             # the same batch delivered again
        land(batch, i)
    assert _rows(bars.merged_bars(spark, out).select(COLS)) == _rows(bars.hourly_bars(events).select(COLS))


def test_watermark_dedupe_keeps_one_copy_and_reports_drops(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    spark.createDataFrame([(1, "2024-01-01 00:00:00", "view"), (2, "2024-01-01 00:10:00", "click")],
                          "event_id long, ts string, event_type string") \
        .withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    stream = dedupe.dedupe_stream(dedupe.replayed_events(spark, src, "*.parquet"), ["event_id"], "ts")
    assert dedupe.run_to_folder(stream, out, ck) == 0
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_landed_dedupe_keeps_late_rows_over_many_batches(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    events = _ticks(spark, src)
    schema = events.schema
    for _ in range(2):                                                       # the second run is a restart with new copies
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        dedupe.land_distinct(stream, ["event_id"], out, ck)
        assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == sorted(r.event_id for r in events.collect())
        events.limit(30).coalesce(1).write.mode("append").parquet(src)


def test_stream_scores_equal_batch_after_out_of_order_slices_and_compaction(spark, tmp_dir):
    landing, store, fresh, scores, ck = (os.path.join(tmp_dir, x) for x in ("landing", "store", "fresh", "scores", "ck"))
    flat = fixtures.candle_flat(spark, SF_SMALL)
    cuts = [F.col("ds") >= "2024-01-20", F.col("ds") < "2024-01-10", (F.col("ds") >= "2024-01-10") & (F.col("ds") < "2024-01-20")]
    schema = None
    for i, cond in enumerate(cuts):
        flat.where(cond).coalesce(1).write.mode("append").parquet(landing)
        schema = schema or spark.read.parquet(landing).schema
        at = store if i < 2 else fresh
        scoring.run_stream_scoring(spark, landing, at, scores, ck, live_score, schema, buckets=4, max_files=1)
        if i == 1:
            assert scoring.compact(spark, store, fresh) == fresh
    cols = ["market_id", "current_prob", "candles_seen", "signal"]
    want = live_score(flat)
    assert _rows(scoring.latest_scores(spark, scores).select(cols)) == _rows(want.select(cols))
    assert flows.surrogate_prob(FE.engineer_features(C.preprocess(flat))).count() == flat.count()
