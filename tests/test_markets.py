import datetime as dt

from candlewick.operators import markets as M

RAW = ("src int, seq long, ticker string, status string, market_type string, mve_collection_ticker string, "
       "result string, volume_fp string")


def test_dedupe_last_wins_keeps_first_position(spark):
    rows = [(0, 5, "A", "closed", "binary", None, "no", "1"), (1, 2, "A", "settled", "binary", "", "yes", "2"),
            (0, 7, "B", "active", "binary", None, "", "3")]
    out = {r.ticker: r for r in M.dedupe_last(spark.createDataFrame(rows, RAW)).collect()}
    assert out["A"].status == "settled" and (out["A"].first_src, out["A"].first_seq) == (0, 5)
    assert out["B"].volume_fp == "3"


def test_valid_markets_rules(spark):
    rows = [(0, 1, "ok", "finalized", "binary", "", "yes", "1"),
            (0, 2, "mve", "closed", "binary", "MVE1", "yes", "1"),
            (0, 3, "scalar", "closed", "scalar", None, "no", "1"),
            (0, 4, "open", "active", "binary", None, "no", "1"),
            (0, 5, "void", "settled", "binary", None, "", "1"),
            (0, 6, "nulls", None, None, None, None, None)]
    got = [r.ticker for r in M.valid_markets(spark.createDataFrame(rows, RAW)).collect()]
    assert got == ["ok"]


def test_selected_legs_array(spark):
    df = spark.createDataFrame([("a", "closed", "binary", None, "yes", []), ("b", "closed", "binary", None, "yes", ["x"]),
                                ("c", "closed", "binary", None, "yes", None)],
                               "ticker string, status string, market_type string, mve_collection_ticker string, "
                               "result string, mve_selected_legs array<string>")
    assert sorted(r.ticker for r in M.valid_markets(df).collect()) == ["a", "c"]


def test_life_window_reasons(spark):
    rows = [("ok", "2024-01-01T00:00:00Z", "2024-01-01T02:00:00Z", None),
            ("settle", "2024-01-01T00:00:00Z", "", "2024-01-01T05:00:00Z"),
            ("missing", None, "2024-01-01T02:00:00Z", None),
            ("backwards", "2024-01-01T02:00:00Z", "2024-01-01T01:00:00Z", None),
            ("short", "2024-01-01T00:00:00Z", "2024-01-01T00:30:00Z", None)]
    df = spark.createDataFrame(rows, "ticker string, open_time string, close_time string, settlement_ts string")
    got = {r.ticker: r.skip_reason for r in M.life_window(df).collect()}
    assert got == {"ok": None, "settle": None, "missing": "missing timestamps", "backwards": "end <= start",
                   "short": "window < 1 hour"}


def test_prefer_source(spark):
    recent = spark.createDataFrame([("A", 1)], "market_id string, v int")
    hist = spark.createDataFrame([("A", 0), ("B", 0)], "market_id string, v int")
    got = sorted(tuple(r) for r in M.prefer_source(recent, hist).collect())
    assert got == [("A", 1, "recent"), ("B", 0, "historical")]


def test_candles_from_quotes_defaults(spark):
    df = spark.createDataFrame([("T-1", "T", 1704067200, (None, "0.5", "bad"))],
                               "market_id string, event_ticker string, end_period_ts long, "
                               "yes_ask struct<close_dollars:string,high_dollars:string,low_dollars:string>")
    r = M.candles_from_quotes(df).first()
    assert (r.close, r.high, r.low) == (0.0, 0.5, None)
    assert r.ds == dt.datetime(2024, 1, 1) and r.series_id == "T"


def test_label_balance_empty_input_is_null_not_error(spark):
    empty = spark.createDataFrame([], "result string")
    r = M.label_balance(empty).first()
    assert (r.yes_count, r.no_count, r.yes_ratio) == (0, 0, None)


def test_question_reads_custom_strike_map(spark):
    df = spark.createDataFrame([(None, "", None, {"Associated Markets": "assoc q"}, "t"),
                                (None, "", None, {}, "t")],
                               "rules_primary string, yes_sub_title string, no_sub_title string, "
                               "custom_strike map<string,string>, title string")
    got = [r.question for r in M.with_question(df).select("question").collect()]
    assert got == ["assoc q", "t"]
