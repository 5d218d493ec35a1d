"""Named queries: one Spark callable and (where SQL can express it) one DuckDB oracle each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def normalise(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output convention shared with the oracle: doubles rounded, integers as bigint,
    timestamps as ``yyyy-MM-dd HH:mm:ss`` text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None, raw: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return out if raw else normalise(out)
        build.__name__ = name
        build.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, build, sql, (fn.__doc__ or "").strip())
        return fn
    return deco
