"""Per-market window specs.

Every per-market operator partitions by ``market_id`` and orders ascending by the
candle time (plus tie-breakers when present), so a chain of them plans one
Exchange and one Sort and then stacks Window operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql.window import WindowSpec

KEY = "market_id"
# ds is derived from end_period_ts, so only the array position breaks ties.
TIE_BREAKERS = ("pos",)


def order_cols(df: DataFrame, order: str = "ds") -> list[str]:
    return [order] + [c for c in TIE_BREAKERS if c in df.columns and c != order]


def w_ordered(df: DataFrame, key: str = KEY, order: str = "ds") -> WindowSpec:
    return Window.partitionBy(key).orderBy(*order_cols(df, order))


def w_all(df: DataFrame, key: str = KEY, order: str = "ds") -> WindowSpec:
    """Whole market, but with the same ordering so it shares the sort of ``w_ordered``."""
    return w_ordered(df, key, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def w_prev(df: DataFrame, k: int, key: str = KEY, order: str = "ds") -> WindowSpec:
    """The previous ``k`` rows, excluding the current one (shift(1).rolling(k))."""
    return w_ordered(df, key, order).rowsBetween(-k, -1)


def w_running(df: DataFrame, key: str = KEY, order: str = "ds") -> WindowSpec:
    return w_ordered(df, key, order).rowsBetween(Window.unboundedPreceding, 0)
