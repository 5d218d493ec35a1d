"""Group-aware splits and folds."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.ordered import dense_positions
from candlewick.session import write_and_read


def group_hash(key: str, seed: int):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def split_sizes(n_groups: int, train: float = 0.70, val: float = 0.15, test: float = 0.15) -> tuple[int, int]:
    """Group counts for test and val: ceil(test * n), then ceil(val / (train + val) * rest)."""
    n_test = math.ceil(test * n_groups)
    n_val = math.ceil(val / (train + val) * (n_groups - n_test))
    return n_test, n_val


HASH_BUCKET_CHARS = 3  # 16^3 = 4,096 buckets of the md5 order


def hash_ranked_groups(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Distinct groups with their 0-based position ``_r`` in md5(seed:key) order and the group count ``_n``.

    md5 digests are uniform, so buckets on the leading hex digits are evenly filled by
    construction (each group is one row): bucket counts form a table of at most 4,096
    rows whose prefix sums are broadcast back; the rank inside a bucket is a window over
    that bucket only.  Deterministic and lazy: no checkpoint, no driver round trip.
    """
    groups = df.select(key).distinct().withColumn("_h", group_hash(key, seed)) \
        .withColumn("_b", F.substring("_h", 1, HASH_BUCKET_CHARS))
    sizes = groups.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # <= 4,096 rows
    offsets = sizes.select("_b", (F.sum("_c").over(Window.orderBy("_b")) - F.col("_c")).alias("_o"),
                           F.sum("_c").over(whole).alias("_n"))
    inside = Window.partitionBy("_b").orderBy("_h", key)
    return groups.join(F.broadcast(offsets), "_b").select(
        key, (F.col("_o") + F.row_number().over(inside) - 1).alias("_r"), "_n")


def assign_groups(df: DataFrame, key: str = "series_id", train: float = 0.70, val: float = 0.15,
                  test: float = 0.15, seed: int = 42) -> DataFrame:
    """One row per group with its split: groups ordered by md5(seed:key), test first, then val.

    Group counts follow ceil(test * n), then ceil(val / (train + val) * rest), in doubles.
    """
    ranked = hash_ranked_groups(df, key, seed)
    n = F.col("_n").cast("double")
    n_test = F.ceil(F.lit(float(test)) * n)
    n_val = F.ceil(F.lit(float(val)) / (F.lit(float(train)) + F.lit(float(val))) * (n - n_test))
    r = F.col("_r")
    return ranked.select(key, F.when(r < n_test, "test").when(r < n_test + n_val, "val").otherwise("train").alias("split"))


def group_split(df: DataFrame, key: str = "series_id", train: float = 0.70, val: float = 0.15,
                test: float = 0.15, seed: int = 42, pin: bool = False) -> DataFrame:
    """G1: adds ``split`` so that no group straddles two splits.

    ``pin=True`` writes the assignment (one row per group) to the shared checkpoint folder,
    so a plan that reads the split several times does not recompute the ranking each time.
    """
    assignment = assign_groups(df, key, train, val, test, seed)
    if pin:
        assignment = write_and_read(assignment, "split-assignment")
    return df.join(assignment, key)


def split_summary(df: DataFrame) -> DataFrame:
    """Rows, markets, series and share of rows per split."""
    s = df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("market_id").alias("markets"),
                                F.countDistinct("series_id").alias("series"))
    total = F.sum("rows").over(Window.partitionBy())  # over the <= 3 split rows
    return s.withColumn("pct_rows", F.col("rows") / total * 100.0)


def fold_of_rank(r, n_folds: int):
    """Snake deal: 0..n-1, n-1..0, 0..n-1, ..."""
    m = r % (2 * n_folds)
    return F.when(m < n_folds, m).otherwise(2 * n_folds - 1 - m)


def assign_folds(df: DataFrame, key: str = "series_id", n_folds: int = 5) -> DataFrame:
    """One row per group: ``n_rows`` and ``fold``; largest groups are dealt first."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    ranked = dense_positions(sizes.withColumn("_neg", -F.col("n_rows")), ["_neg", key], "_r")
    return ranked.select(key, "n_rows", fold_of_rank(F.col("_r"), n_folds).cast("int").alias("fold"))


def group_folds(df: DataFrame, key: str = "series_id", n_folds: int = 5, pin: bool = False) -> DataFrame:
    """Adds ``fold``; no group straddles two folds (``pin`` as in ``group_split``)."""
    assignment = assign_folds(df, key, n_folds).select(key, "fold")
    if pin:
        assignment = write_and_read(assignment, "fold-assignment")
    return df.join(assignment, key)


def dev_union(df: DataFrame) -> DataFrame:
    """Train and val rows together (the cross-validation set)."""
    return df.where(F.col("split").isin("train", "val"))
