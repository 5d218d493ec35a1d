"""Market-table operators (M1-M16): relational work over market metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.config import VALID_RESULTS, VALID_STATUSES
from candlewick.functions.columns import (
    is_falsy_text, iso_to_unix, keyword_match, label_col, question_col, to_float, ts_from_epoch, zero_default,
)

def union_sources(hist: DataFrame, recent: DataFrame) -> DataFrame:
    """M1: historical then recent markets (UNION ALL), tagged with ``src`` 0 / 1."""
    return (hist.withColumn("src", F.lit(0))
            .unionByName(recent.withColumn("src", F.lit(1)), allowMissingColumns=True))


def dedupe_last(df: DataFrame, key: str = "ticker", order=("src", "seq"), cols=None) -> DataFrame:
    """M2: one row per key; the last (src, seq) wins, and ``first_src``/``first_seq`` keep the
    position of the key's first appearance (where an insertion-ordered dict keeps it).

    An aggregate, not a window: copies of a hot key are combined map-side before the shuffle.
    ``cols`` names the columns to carry besides the key and the order (default: all); the row is
    packed as a whole, so only the named ones reach the scan.
    """
    others = [c for c in df.columns if c != key and (cols is None or c in cols or c in order)]
    pos = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), pos).alias("_last"),
        F.min(pos).alias("_first"),
    )
    return agg.select(key, "_last.*", *[F.col(f"_first.{c}").alias(f"first_{c}") for c in order])


def source_counts(df: DataFrame, key: str = "ticker") -> DataFrame:
    """M3: historical count, recent count, unique keys."""
    return df.agg(
        F.count_if(F.col("src") == 0).alias("historical"),
        F.count_if(F.col("src") == 1).alias("recent"),
        F.countDistinct(key).alias("unique"),
    )


def bounded(df: DataFrame, order, n: int) -> DataFrame:
    """M4: the first ``n`` rows in ``order`` (top-k per partition, then one bounded merge)."""
    return df.orderBy(*order).limit(n)


def valid_markets(df: DataFrame) -> DataFrame:
    """M5: resolved plain binary markets."""
    cond = (F.col("status").isin(VALID_STATUSES) & (F.col("market_type") == "binary")
            & is_falsy_text(F.col("mve_collection_ticker")) & F.col("result").isin(VALID_RESULTS))
    if "mve_selected_legs" in df.columns:
        legs = F.col("mve_selected_legs")
        empty = legs.isNull() | ((F.size(legs) == 0) if isinstance(df.schema["mve_selected_legs"].dataType, T.ArrayType)
                                 else (legs == ""))
        cond = cond & empty
    return df.where(F.coalesce(cond, F.lit(False)))


def keyword_filter(df: DataFrame, question: str, keywords) -> DataFrame:
    """M6: whole-word, case-insensitive match of any keyword."""
    return df.where(keyword_match(F.col(question), keywords))


def with_question(df: DataFrame, associated: str | None = None) -> DataFrame:
    """M7: adds ``question`` (first non-empty of the fallback chain)."""
    assoc = associated if associated else ("custom_strike" if "custom_strike" in df.columns else None)
    if assoc == "custom_strike":
        return df.withColumn("question", question_col())
    return df.withColumn("question", question_col(associated=F.col(assoc) if assoc else F.lit(None).cast("string")))


def with_label(df: DataFrame) -> DataFrame:
    """M8."""
    return df.withColumn("label", label_col())


SAMPLE_INPUT = ("status", "market_type", "mve_collection_ticker", "mve_selected_legs", "result", "rules_primary", "yes_sub_title",
                "no_sub_title", "associated_markets", "custom_strike", "title", "yes_ask_dollars", "no_ask_dollars",
                "last_price_dollars", "volume_fp")


def market_samples(df: DataFrame, keywords, max_samples: int | None = None,
                   order=("first_src", "first_seq")) -> DataFrame:
    """M9: every valid market, projected to the sample schema.

    ``max_samples`` keeps the first ``max_samples + 1`` in arrival order (a builder that stops only
    after exceeding its cap); by default nothing is cut.
    """
    q = with_question(df, "associated_markets" if "associated_markets" in df.columns else None)
    ok = keyword_filter(valid_markets(q), "question", keywords)
    if max_samples is not None:
        ok = bounded(ok, list(order), max_samples + 1)
    return ok.select(
        F.col("ticker").alias("market_id"),
        to_float("yes_ask_dollars").alias("yes_price"),
        to_float("no_ask_dollars").alias("no_price"),
        to_float("last_price_dollars").alias("last_price_dollars"),
        F.array(zero_default("volume_fp")).alias("volume_history"),
        F.lit(None).cast("double").alias("price_momentum"),
        F.lit(None).cast("double").alias("volume_weighted_price"),
        F.lit(0.0).alias("time_to_resolution"),
        F.col("question").alias("rag_query"),
        label_col().alias("label"),
    )


def label_balance(df: DataFrame, result: str = "result") -> DataFrame:
    """YES count, NO count, YES share of all rows (NULL on empty input)."""
    return df.agg(
        F.count_if(F.col(result) == "yes").alias("yes_count"),
        F.count_if(F.col(result) == "no").alias("no_count"),
        F.try_divide(F.count_if(F.col(result) == "yes"), F.count(F.lit(1))).alias("yes_ratio"),
    )


def preview(df: DataFrame, n: int = 10, order=("src", "seq")) -> DataFrame:
    """The first ``n`` markets with display defaults."""
    return bounded(df, list(order), n).select(
        F.coalesce("title", F.lit("N/A")).alias("title"),
        F.coalesce("ticker", F.lit("N/A")).alias("ticker"),
        F.coalesce("status", F.lit("N/A")).alias("status"),
        F.coalesce("market_type", F.lit("N/A")).alias("market_type"),
        to_float(F.coalesce("yes_ask_dollars", F.lit("0"))).alias("yes_price"),
        to_float(F.coalesce("no_ask_dollars", F.lit("0"))).alias("no_price"),
        to_float(F.coalesce("volume_fp", F.lit("0"))).alias("volume"),
        F.coalesce("result", F.lit("unresolved")).alias("result"),
        F.coalesce(F.col("close_time").cast("string"), F.lit("N/A")).alias("close_time"),
    )


def _epoch(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return iso_to_unix(F.nullif(c, F.lit("")))
    return F.unix_timestamp(c.cast("timestamp"))


def life_window(df: DataFrame, open_col="open_time", close_col="close_time",
                settle_col="settlement_ts", min_seconds: int = 3600) -> DataFrame:
    """start/end epoch seconds and a ``skip_reason`` (NULL = usable)."""
    def present(name):
        c = F.col(name)
        return c.isNotNull() & (c.cast("string") != "")
    start_present = present(open_col)
    end_present = present(close_col) | present(settle_col)
    end_raw = F.when(present(close_col), _epoch(df, close_col)).otherwise(_epoch(df, settle_col))
    out = df.withColumns({"start_ts": _epoch(df, open_col), "end_ts": end_raw})
    reason = (F.when(~start_present | ~end_present, F.lit("missing timestamps"))
              .when(F.col("start_ts").isNull() | F.col("end_ts").isNull(), F.lit("bad timestamp"))
              .when(F.col("end_ts") <= F.col("start_ts"), F.lit("end <= start"))
              .when(F.col("end_ts") - F.col("start_ts") < min_seconds, F.lit("window < 1 hour")))
    return out.withColumn("skip_reason", reason)


def join_labels(markets: DataFrame, samples: DataFrame, key: str = "ticker") -> DataFrame:
    """Left join the sample label by ticker (duplicate sample keys: last wins)."""
    labels = samples.select(F.col("market_id").alias(key), "label")
    if "seq" in samples.columns:
        labels = dedupe_last(samples.select(F.col("market_id").alias(key), "label", "seq"), key, ("seq",))
    return markets.join(labels.select(key, "label"), key, "left")


def prefer_source(recent: DataFrame, hist: DataFrame, key: str = "market_id") -> DataFrame:
    """Recent rows, plus historical rows only for keys the recent source lacks."""
    keys = recent.select(key).distinct()  # combined map-side: one key per market crosses the shuffle
    return (recent.withColumn("source", F.lit("recent"))
            .unionByName(hist.join(keys, key, "left_anti").withColumn("source", F.lit("historical"))))


def _quote_price(field: Column) -> Column:
    # missing -> 0 (dict default), present -> parsed, unparsable -> NULL
    return F.when(field.isNull(), F.lit(0.0)).otherwise(to_float(field))


def candles_from_quotes(quotes: DataFrame, keep=()) -> DataFrame:
    """Ds from epoch; close/high/low from the yes-ask quote (missing -> 0)."""
    return quotes.select(
        F.col("market_id"),
        F.col("event_ticker").alias("series_id"),
        ts_from_epoch("end_period_ts").alias("ds"),
        "end_period_ts",
        _quote_price(F.col("yes_ask.close_dollars")).alias("close"),
        _quote_price(F.col("yes_ask.high_dollars")).alias("high"),
        _quote_price(F.col("yes_ask.low_dollars")).alias("low"),
        *keep,
    )


def skip_report(markets: DataFrame, quotes: DataFrame) -> DataFrame:
    """M16 report: (ticker, skip_reason) of every market that yields no series; a usable market without
    a candle in its window is ``empty``."""
    w = life_window(markets).select("ticker", "start_ts", "end_ts", "skip_reason")
    got = (quotes.select(F.col("market_id").alias("ticker"), "end_period_ts").join(w.where("skip_reason IS NULL"), "ticker")
           .where(F.col("end_period_ts").between(F.col("start_ts"), F.col("end_ts"))).select("ticker").distinct())
    return (w.join(got, "ticker", "left_anti")
            .select("ticker", F.coalesce("skip_reason", F.lit("empty")).alias("skip_reason")))


def build_series(markets: DataFrame, quotes: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Life window -> candles inside it -> quote candles -> labels; markets without
    candles vanish (inner join).  ``skip_report`` lists them with the reason.

    Labels come from ``samples`` (left join by ticker) or, when none is given, travel
    with the market metadata's own ``label`` column.
    """
    carry = ["label"] if (samples is None and "label" in markets.columns) else []
    ok = life_window(markets).where(F.col("skip_reason").isNull()).select(
        F.col("ticker").alias("market_id"), "event_ticker", "start_ts", "end_ts", *carry)
    q = quotes.drop("event_ticker") if "event_ticker" in quotes.columns else quotes
    inside = q.join(ok, "market_id").where(F.col("end_period_ts").between(F.col("start_ts"), F.col("end_ts")))
    out = candles_from_quotes(inside, carry)
    if samples is not None:
        out = join_labels(out.withColumnRenamed("market_id", "ticker"), samples, "ticker") \
            .withColumnRenamed("ticker", "market_id")
    return out

