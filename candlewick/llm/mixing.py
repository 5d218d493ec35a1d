"""Mixing sources to target weights by hash-threshold histograms.

Every row has a fixed hash. A source's budget is filled by whole passes over the source plus those rows
whose hash lies below the source's threshold. The thresholds are found without sorting rows: sizes are
summed by (source, leading hash bits), the bucket where the running sum crosses the budget is the only
one that is summed again by its next bits, and so on until single hashes are left.

Defined results: a null source is a source of its own, last in order; a null text or size counts 0; rows
with equal ids share a hash and are taken or left together, rows without an id by equal texts; a source of size 0 has target 0 and takes
nothing; an empty table gives an empty result. Input columns other than those named are kept by
``mix`` (names starting with ``_mix`` are reserved).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import write_and_read

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)     # by source in code-point order, repeating
SHARE = 1.5                   # of all sizes
MOST = 2.0                    # times a source's (and a row's) size
HASH_BITS, LEVEL_BITS = 60, 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def row_hash(key: Column, text: Column | None = None) -> Column:
    """60-bit hash of a key's text (md5, so that SQL engines can repeat it); rows without a key go by ``text``."""
    body = F.lit("") if text is None else F.concat(F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), body)), 1, 15), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Weighted shares of ``share`` times all sizes; a source stops at ``most`` times its own size and the
    excess goes to the others by weight. In order of cap per weight, the sources that stop are a prefix,
    so one pass of running sums over the source table (one row per source) settles all rounds.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = sizes.withColumn("_w", F.get(w, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    ranked = ranked.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / F.sum("_w").over(onwards))
    return (ranked.withColumn("_level", level).withColumn("_at", F.row_number().over(by_ratio))
            .withColumn("_open", F.min(F.when(F.col("_cap") / F.col("_w") >= F.col("_level"), F.struct("_at", "_level")))
                        .over(every)["_level"])
            .withColumn("target", F.when(F.col("_open").isNull(), F.col("_cap"))
                        .otherwise(F.least(F.col("_cap"), F.col("_w") * F.col("_open"))))
            .select("source", "source_size", "target"))


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, whole, below): each source takes every row ``whole`` times and the rows with hash < ``below``
    once more. ``rows``: (source, size, h); ``plan``: (source, source_size, target).

    The row group on the budget's edge is taken if that brings the sum nearer to the budget.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    edge = (plan.withColumn("whole", whole.cast("bigint"))
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
            .withColumn("prefix", F.lit(0).cast("bigint"))
            .select("source", "whole", "rest", "prefix", F.col("source_size").alias("within")))
    edge = write_and_read(edge, "mix-edge")
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = (rows.join(edge.select(F.col("source").alias("_s"), "prefix"), F.col("source").eqNullSafe(F.col("_s")), "inner")
                  .where(F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
                  .groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("n")))
        run = Window.partitionBy("source").orderBy("bucket")
        crossing = (inside.withColumn("upto", F.sum("n").over(run))
                    .join(edge.select(F.col("source").alias("_s"), "whole", "rest"),
                          F.col("source").eqNullSafe(F.col("_s")), "inner")
                    .where(F.col("upto") > F.col("rest"))
                    .groupBy("source").agg(F.min(F.struct("bucket", "n", "upto")).alias("c")))
        # a source whose budget is not crossed keeps an edge beyond all its rows
        edge = write_and_read(
            edge.alias("e").join(crossing.select(F.col("source").alias("_s"), "c"),
                                 F.col("source").eqNullSafe(F.col("_s")), "left")
            .select("source", "whole",
                    F.when(F.col("c").isNull(), F.col("rest")).otherwise(F.col("rest") - (F.col("c.upto") - F.col("c.n"))).alias("rest"),
                    F.when(F.col("c").isNull(), F.shiftleft(F.col("prefix") + 1, LEVEL_BITS)).otherwise(F.col("c.bucket")).alias("prefix"),
                    F.when(F.col("c").isNull(), F.lit(0)).otherwise(F.col("c.n")).cast("bigint").alias("within")), "mix-edge")
    nearer = (F.col("within") > 0) & (F.col("within") - F.col("rest") < F.col("rest"))
    return edge.select("source", "whole", (F.col("prefix") + nearer.cast("bigint")).alias("below"))


def _hash(df: DataFrame, key: str) -> Column:
    return row_hash(F.col(key), F.col("text") if "text" in df.columns else None)


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", size: Column | None = None,
        weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> tuple[DataFrame, DataFrame]:
    """(rows, cuts): the written (id, source, size, h) of each row, and per source its size, target, whole
    passes and hash threshold (``_mix_s``, ``_mix_source_size``, ``_mix_target``, ``whole``, ``below``).

    The text is read once for the sizes; the histograms read a narrow written table of them.
    """
    size = word_count(F.col("text")) if size is None else size
    narrow = write_and_read(df.select(F.col(key).alias("id"), F.col(source).alias("source"), size.alias("size"),
                                      _hash(df, key).alias("h")), "mix-rows")
    plan = write_and_read(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-plan")
    cut = thresholds(narrow.select("source", "size", "h"), plan)
    per = write_and_read(
        plan.join(cut.select(F.col("source").alias("_s"), "whole", "below"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "mix-cut")
    per = per.select(F.col("source").alias("_mix_s"), F.col("source_size").alias("_mix_source_size"),
                     F.col("target").alias("_mix_target"), "whole", "below")
    return narrow, per


def taken(df: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, size, source_size, target of its source, copies, and words taken (size x copies)."""
    narrow, per = mix(df, **options)
    copies = F.col("whole") + (F.col("h") < F.col("below")).cast("bigint")
    return (narrow.join(per, F.col("source").eqNullSafe(F.col("_mix_s")), "left")
            .select(F.col("id").alias("doc_id"), "size", F.col("_mix_source_size").alias("source_size"),
                    F.col("_mix_target").alias("target"), (F.col("size") * copies).alias("taken"), copies.alias("copies")))


def mixed(df: DataFrame, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, with ``df``'s own columns."""
    _, per = mix(df, key=key, source=source, **options)
    copies = F.col("whole") + (_hash(df, key) < F.col("below")).cast("bigint")
    return (df.join(per, F.col(source).eqNullSafe(F.col("_mix_s")), "inner")
            .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.lit(int(MOST))))).where(F.col("_mix_copy") <= copies)
            .select(*[F.col(f"`{c}`") for c in df.columns]))
