"""Scalar column builders (all JVM-side built-ins; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.config import (
    ASSOCIATED_MARKETS_KEY, SIGNAL_MIN_CANDLES, SIGNAL_NO_BELOW, SIGNAL_TOO_EARLY, SIGNAL_YES_ABOVE,
)

__all__ = [
    "col_of", "nan_to_null", "to_float", "zero_default", "series_id_col", "series_ticker_col",
    "iso_to_unix", "ts_from_epoch", "ts_to_string", "py_strip", "question_col", "label_col",
    "keyword_pattern", "keyword_match", "signal_col", "edge_col", "is_falsy_text", "rounded",
    "clip_unit",
]

# Python float() grammar accepted for numbers held in strings (underscores between digits are
# removed first, as float() allows them; 'nan' parses but means missing).
_NUMBER_RE = r"^[+-]?(([0-9]+\.?[0-9]*)|(\.[0-9]+))([eE][+-]?[0-9]+)?$"
_INF_RE = r"^[+-]?(inf|infinity)$"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = col_of(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_float(c, source_type: str = "string") -> Column:
    """Parse like Python ``float()``; bad text, null and NaN become NULL (missing)."""
    c = col_of(c)
    if source_type != "string":
        return nan_to_null(c.cast("double"))
    t = F.trim(c)
    # Fast path: text made only of digits, sign, point and exponent parses the same way in
    # Spark and in Python, so a plain try_cast suffices (no regex for ordinary numbers).
    plain = F.translate(t, "0123456789+-.eE", "") == ""
    s = F.regexp_replace(t, r"(?<=[0-9])_(?=[0-9])", "")
    low = F.lower(s)
    careful = (F.when(s.rlike(_NUMBER_RE), s.try_cast("double"))
               .when(low.rlike(_INF_RE),
                     F.when(low.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))))
    return F.when(plain, t.try_cast("double")).otherwise(careful).cast("double")


def zero_default(c, source_type: str = "string") -> Column:
    """``float(x or 0)``: null, '' and 0 give 0.0; unparsable text gives NULL."""
    c = col_of(c)
    if source_type != "string":
        return F.coalesce(nan_to_null(c.cast("double")), F.lit(0.0))
    return F.when(c.isNull() | (c == ""), F.lit(0.0)).otherwise(to_float(c))


def series_id_col(market_id="market_id") -> Column:
    """Ticker minus its last ``-suffix``; unchanged when there is no dash."""
    return F.regexp_replace(col_of(market_id), r"-[^-]*\z", "")


def series_ticker_col(ticker="ticker") -> Column:
    """Text before the first dash."""
    return F.substring_index(col_of(ticker), "-", 1)


def iso_to_unix(c) -> Column:
    """ISO-8601 text (``Z`` or offset suffix) to epoch seconds, truncated; bad text gives NULL."""
    return F.unix_timestamp(F.try_to_timestamp(col_of(c)))


def ts_from_epoch(c) -> Column:
    return F.timestamp_seconds(col_of(c))


def ts_to_string(c) -> Column:
    return F.date_format(col_of(c), "yyyy-MM-dd HH:mm:ss")


def py_strip(c) -> Column:
    """Python ``str.strip()``: trims all leading and trailing whitespace."""
    return F.regexp_replace(col_of(c), r"^\s+|\s+$", "")


def is_falsy_text(c) -> Column:
    c = col_of(c)
    return c.isNull() | (c == "")


def question_col(rules="rules_primary", yes_sub="yes_sub_title", no_sub="no_sub_title",
                 associated=None, title="title") -> Column:
    """First non-empty of: stripped rules, yes subtitle, no subtitle, associated markets, title.

    ``associated`` defaults to ``custom_strike['Associated Markets']``.
    """
    assoc = (F.element_at(F.col("custom_strike"), ASSOCIATED_MARKETS_KEY)
             if associated is None else col_of(associated))
    return F.coalesce(
        F.nullif(py_strip(rules), F.lit("")),
        F.nullif(col_of(yes_sub), F.lit("")),
        F.nullif(col_of(no_sub), F.lit("")),
        F.nullif(assoc, F.lit("")),
        col_of(title),
    )


def label_col(result="result") -> Column:
    return F.when(col_of(result) == "yes", F.lit(1.0)).otherwise(F.lit(0.0))


_REGEX_META = set(r".^$|?*+()[]{}\\")


def _escape(word: str) -> str:
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in word)


def keyword_pattern(keywords, unicode_flag: bool = True) -> str:
    """One alternation of whole-word, case-folded keywords (any-of == one alternation)."""
    alt = "|".join(_escape(k.lower()) for k in keywords)
    return ("(?U)" if unicode_flag else "") + r"\b(?:" + alt + r")\b"


def keyword_match(question, keywords) -> Column:
    q = col_of(question)
    return F.coalesce(F.lower(q).rlike(keyword_pattern(keywords)), F.lit(False))


def signal_col(prob="current_prob", n="candles_seen") -> Column:
    p, n = col_of(prob), col_of(n)
    return (F.when(n < SIGNAL_MIN_CANDLES, F.lit(SIGNAL_TOO_EARLY))
            .when(p > SIGNAL_YES_ABOVE, F.lit("YES"))
            .when(p < SIGNAL_NO_BELOW, F.lit("NO"))
            .otherwise(F.lit("UNCERTAIN")))


def edge_col(prob="prob", price="close", margin: float = 0.05) -> Column:
    """BUY when the probability is above the price by more than ``margin``, SELL when below."""
    p, c = col_of(prob), col_of(price)
    return (F.when(p.isNull() | c.isNull(), F.lit(None).cast("string"))
            .when(p - c > margin, F.lit("BUY"))
            .when(c - p > margin, F.lit("SELL"))
            .otherwise(F.lit("HOLD")))


def rounded(c, digits: int = 6) -> Column:
    return F.round(col_of(c), digits)


def clip_unit(c, lo: float = 0.01, hi: float = 0.99) -> Column:
    """Two-sided clip; NULL stays NULL (least/greatest alone would skip it)."""
    c = col_of(c)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))
