import math

from pyspark.sql import functions as F

from candlewick.config import POLITICAL_KEYWORDS
from candlewick.functions import columns as FN


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_to_float_like_python(spark):
    cases = {"0.25": 0.25, " 1.5 ": 1.5, "1_000": 1000.0, "1e-3": 0.001, "-2": -2.0, ".5": 0.5,
             "abc": None, "": None, None: None, "nan": None, "1.5d": None, "inf": math.inf, "-Infinity": -math.inf}
    for text, want in cases.items():
        assert one(spark, FN.to_float("x"), text) == want, text


def test_zero_default(spark):
    for text, want in {None: 0.0, "": 0.0, "0": 0.0, "12.5": 12.5, "bad": None}.items():
        assert one(spark, FN.zero_default("x"), text) == want, text


def test_series_ids(spark):
    assert one(spark, FN.series_id_col("x"), "KX-26FEB18-NATO") == "KX-26FEB18"
    assert one(spark, FN.series_id_col("x"), "NODASH") == "NODASH"
    assert one(spark, FN.series_id_col("x"), "A-") == "A"
    assert one(spark, FN.series_ticker_col("x"), "KX-26FEB18-NATO") == "KX"
    assert one(spark, FN.series_ticker_col("x"), "NODASH") == "NODASH"


def test_iso_to_unix(spark):
    assert one(spark, FN.iso_to_unix("x"), "2026-02-17T15:00:00Z") == 1771340400
    assert one(spark, FN.iso_to_unix("x"), "2026-02-17T16:00:00.9+00:00") == 1771344000
    assert one(spark, FN.iso_to_unix("x"), "garbage") is None


def test_question_fallback_order(spark):
    schema = "rules_primary string, yes_sub_title string, no_sub_title string, a string, title string"
    rows = [("  rule  ", "y", "n", "a", "t"), ("  ", "y", "n", "a", "t"), (None, "", "n", "a", "t"),
            (None, None, None, "a", "t"), (None, None, None, "", "t"), ("\t\n", "  ", None, None, "t")]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(FN.question_col(associated=F.col("a"))).collect()]
    assert got == ["rule", "y", "n", "a", "t", "  "]


def test_keyword_whole_word_case_insensitive(spark):
    kws = ["Senate", "tax bill", "Prime MinisterSCOTUS & courts"]
    df = spark.createDataFrame([("Will the SENATE vote?",), ("senatorial",), ("The Tax Bill passes",),
                                ("prime ministerscotus & courts",), (None,)], "q string")
    got = [r[0] for r in df.select(FN.keyword_match(F.col("q"), kws)).collect()]
    assert got == [True, False, True, True, False]
    assert len(POLITICAL_KEYWORDS) == 72


def test_signal_and_edge(spark):
    df = spark.createDataFrame([(0.9, 2), (0.9, 3), (0.2, 5), (0.5, 5), (0.65, 5)], "p double, n long")
    got = [r[0] for r in df.select(FN.signal_col("p", "n")).collect()]
    assert got == ["TOO EARLY — need more candles", "YES", "NO", "UNCERTAIN", "UNCERTAIN"]
    e = spark.createDataFrame([(0.7, 0.5), (0.3, 0.5), (0.52, 0.5), (None, 0.5)], "p double, c double")
    assert [r[0] for r in e.select(FN.edge_col("p", "c")).collect()] == ["BUY", "SELL", "HOLD", None]


def test_clip_unit_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (2.0,), (0.5,)], "x double")
    assert [r[0] for r in df.select(FN.clip_unit("x")).collect()] == [None, 0.01, 0.99, 0.5]


def test_to_float_agrees_with_python_on_tricky_text(spark):
    corpus = ["1__0", "_1", "1E+05", "+.5", "5.", ".", "+", "-", "e5", "1e", "1e5.5", "1.2.3", "--1", "+-1", "   ",
              "NaN", "-inf", "Infinity", "infinity", "1.5f", "2D", "0x1p3", "1,5", "0.4500", "1.0E-4", "00012", "-0",
              "1e308", "1e309", "4.9e-324"]

    def py(x):
        try:
            v = float(x)
        except ValueError:
            return None
        return None if math.isnan(v) else v
    df = spark.createDataFrame([(x,) for x in corpus], "x string")
    got = [r[0] for r in df.select(FN.to_float("x")).collect()]
    assert got == [py(x) for x in corpus]
