"""Global running sums without an unpartitioned window.

``Window.orderBy(...)`` with no partition moves every row into one task.  Instead:
range-partition on the order key (Spark samples the key, so even one hot key value is
split by the later order columns), record each row's range id and pin it by writing the
table to the shared checkpoint folder, sum each range, prefix-sum those few totals (one
row per range), broadcast them and add them to a running sum inside each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import write_and_read


def running_sums(df: DataFrame, order: list, values: dict[str, Column], num_partitions: int | None = None,
                 pin: bool = True) -> DataFrame:
    """Adds inclusive running sums ``values`` (name -> expression) in global ``order``.

    ``order`` must be a total order (unique) for the result to be deterministic.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = df.withColumns({f"_v_{k}": v for k, v in values.items()})
    ranged = staged.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    if pin:  # range ids become data: recomputation can never re-sample different bounds
        ranged = write_and_read(ranged, "ranges")
    totals = ranged.groupBy("_pid").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in values])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # <= n rows
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}")
                                      for k in values])
    joined = ranged.join(F.broadcast(offsets), "_pid")
    inside = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = joined.withColumns({k: F.col(f"_o_{k}") + F.sum(f"_v_{k}").over(inside) for k in values})
    return out.drop("_pid", *[f"_v_{k}" for k in values], *[f"_o_{k}" for k in values])


def dense_positions(df: DataFrame, order: list, name: str = "rank0", **kw) -> DataFrame:
    """0-based position of each row in global ``order`` (rows must be unique in order)."""
    return running_sums(df, order, {name: F.lit(1)}, **kw).withColumn(name, F.col(name) - 1)


def spread(per_key: DataFrame, rows: DataFrame, key: str, part: str) -> DataFrame:
    """``per_key`` (one row per key) repeated for every (key, part) of ``rows``, so that the rows can be joined
    on both and a hot key's rows stay spread over its parts."""
    return rows.select(key, part).distinct().join(per_key, key)


def group_quantile(df: DataFrame, key: str, col: str, q: float, out: str = "quantile", part: str | None = None) -> DataFrame:
    """Exact per-group ``q`` quantile of ``col`` (linear interpolation, NULLs ignored), one row per group.

    Skew-safe: values are ranked inside their group by a range-partitioned running count
    over (key, value) (a hot group is spread over many ranges), and only the two values at
    the neighbouring ranks of (n - 1) * q are kept per group.  With ``part`` (a column that cuts a
    group into bounded parts) the rows meet their group's count on (key, part), never on a bare hot key.
    """
    on = [key] + ([part] if part else [])
    v = df.select(*on, col).where(F.col(col).isNotNull())
    ranked = running_sums(v, [key, col], {"_cum": F.lit(1)})
    group = ranked.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min("_cum").alias("_c0"))
    pos = (F.col("_n") - 1) * F.lit(float(q))
    r = ranked.join(spread(group, v, key, part) if part else group, on).withColumns({
        "_r": F.col("_cum") - F.col("_c0"), "_pos": pos, "_lo": F.floor(pos), "_hi": F.ceil(pos)})
    picks = r.where((F.col("_r") == F.col("_lo")) | (F.col("_r") == F.col("_hi"))).groupBy(key).agg(
        F.max(F.when(F.col("_r") == F.col("_lo"), F.col(col))).alias("_vlo"),
        F.max(F.when(F.col("_r") == F.col("_hi"), F.col(col))).alias("_vhi"),
        F.max("_pos").alias("_pos"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    value = F.when(F.col("_hi") == F.col("_lo"), F.col("_vlo")).otherwise(
        (F.col("_hi") - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * F.col("_vhi"))
    return picks.select(key, value.alias(out))
