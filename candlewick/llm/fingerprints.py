"""Document fingerprints: a threshold-scaled sketch of word shingles.

Every shingle hash below ``fraction`` of the hash range is kept, whatever the length of the text, so the
sketch of a union is the union of the sketches (``merge``) and the share of one text's shingles found in
another (containment) can be estimated between texts of very unequal length. If no hash of a non-empty
text lies below the threshold, its smallest hash alone is kept, so that short texts compare by it.

Defined results: null text = empty text = empty fingerprint ''; two empty fingerprints have likeness 1,
an empty and a non-empty one 0. Extra columns of the input are ignored by the query and kept by
``with_fingerprint``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.text import U, shingle_hashes, slices, unique_per_row

FRACTION_BITS = 2      # keep hashes below 2**-2 of the range
WIDTH = 5              # words per shingle
DIGITS = 10            # a kept hash is written with its leading 40 bits, 10 hex digits


def sketch_rows(arr: pa.Array, fraction_bits: int = FRACTION_BITS, width: int = WIDTH) -> list[str]:
    """Fingerprint text of each string: the kept hashes ascending, 10 hex digits each."""
    out: list[str] = []
    for _, _, data, off in slices(arr):
        h, soff = shingle_hashes(data, off, width)
        row = np.repeat(np.arange(len(off) - 1), np.diff(soff))
        kept = h < U(1 << (64 - fraction_bits))
        has = np.zeros(len(off) - 1, bool)
        has[row[kept]] = True
        lone = np.flatnonzero(~has & (np.diff(soff) > 0))
        if len(lone):
            least = np.minimum.reduceat(h, soff[lone]) if len(lone) == len(soff) - 1 else \
                np.array([h[soff[i]:soff[i + 1]].min() for i in lone], U)
            for i, v in zip(lone, least, strict=True):
                kept[soff[i]:soff[i + 1]] |= h[soff[i]:soff[i + 1]] == v
        v, koff, _ = unique_per_row(h[kept] >> U(24), np.searchsorted(row[kept], np.arange(len(off))))
        text = v.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().hex()
        out += [text[DIGITS * a:DIGITS * b] for a, b in zip(koff[:-1], koff[1:], strict=True)]
    return out


def _keys(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(rows)), np.uint8).reshape(-1, DIGITS // 2)
    value = np.zeros((len(raw), 8), np.uint8)
    value[:, 3:] = raw
    n = np.array([len(r) // DIGITS for r in rows], np.int64)
    row = np.repeat(np.arange(len(rows), dtype=np.uint64), n)
    return (row << U(40)) | value.view(">u8").ravel().astype(U), n


def compare_rows(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(likeness, containment of a in b, containment of b in a) of fingerprints, pair by pair."""
    ka, na = _keys(a)
    kb, nb = _keys(b)
    both = np.intersect1d(ka, kb, assume_unique=True) >> U(40)
    n = np.bincount(both.astype(np.int64), minlength=len(a)).astype(float)
    either = na + nb - n
    none = either == 0
    share = lambda size: np.where(none, 1.0, n / np.maximum(size, 1))
    return share(either), share(na), share(nb)


def fingerprint(text: Column, fraction_bits: int = FRACTION_BITS, width: int = WIDTH) -> Column:
    """Fingerprint string of a text column."""
    @F.arrow_udf("string")
    def udf(t: pa.Array) -> pa.Array:
        return pa.array(sketch_rows(t, fraction_bits, width), pa.string())
    return udf(text)


def merge(a: Column, b: Column, fraction_bits: int = FRACTION_BITS) -> Column:
    """Fingerprint of two texts taken together (their shingles' union)."""
    @F.arrow_udf("string")
    def udf(x: pa.Array, y: pa.Array) -> pa.Array:
        top, out = f"{1 << (40 - fraction_bits):010x}", []
        for p, q in zip(x.to_pylist(), y.to_pylist(), strict=True):
            both = sorted({s[i:i + DIGITS] for s in (p or "", q or "") for i in range(0, len(s), DIGITS)})
            low = [v for v in both if v < top]
            out.append("".join(low or both[:1]))
        return pa.array(out, pa.string())
    return udf(a, b)


def likeness(a: Column, b: Column) -> Column:
    """struct(likeness, a_in_b, b_in_a): estimated Jaccard similarity and both containments."""
    @F.arrow_udf("struct<likeness: double, a_in_b: double, b_in_a: double>")
    def udf(x: pa.Array, y: pa.Array) -> pa.Array:
        cols = compare_rows(x.fill_null("").to_pylist(), y.fill_null("").to_pylist())
        return pa.StructArray.from_arrays([pa.array(c) for c in cols], ["likeness", "a_in_b", "b_in_a"])
    return udf(a, b)


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    return df.withColumn(out, fingerprint(F.col(text)))


def in_descending_runs(df: DataFrame, key: str = "doc_id", per_run: int = 256, most_runs: int = 65536) -> DataFrame:
    """Rows with ``_run`` and ``_halo``: key ranges in descending order, each holding a copy (``_halo``) of
    the first row(s) of the range after it (after the last range: of the first), so that a window inside a
    run sees every row's successor. One shuffle of the rows; null keys come last.

    The driver holds the range bounds only: at most ``most_runs`` of them, one row each.
    """
    ids = df.select(F.col(key).cast("bigint").alias("k"))
    total = ids.count()
    runs = max(1, min(most_runs, -(-total // per_run)))
    bounds: list[int] = []
    if runs > 1:
        cut = ids.select(F.percentile_approx("k", [i / runs for i in range(1, runs)], max(10_000, 10 * runs))).first()[0]
        bounds = sorted(set(cut or []))
    # run 0 holds the largest keys; nulls have a run of their own at the end
    cuts = F.array(*[F.lit(b).cast("bigint") for b in bounds]) if len(bounds) <= 64 else None
    spark = df.sparkSession
    if cuts is not None:
        low = F.size(F.filter(cuts, lambda c: c < F.col("k"))) if bounds else F.lit(0)
        run = F.when(F.col("k").isNull(), F.lit(len(bounds) + 1)).otherwise(F.lit(len(bounds)) - low)
    else:
        arr = np.array(bounds, np.int64)

        @F.arrow_udf("int")
        def locate(k: pa.Array) -> pa.Array:
            v = k.fill_null(0).to_numpy(zero_copy_only=False)
            got = len(arr) - np.searchsorted(arr, v, "left")
            got = np.where(k.is_null().to_numpy(zero_copy_only=False), len(arr) + 1, got)
            return pa.array(got.astype(np.int32))
        run = locate(F.col("k"))
    heads = sorted((r[0], r[1]) for r in ids.select(run.cast("int").alias("run"), "k").groupBy("run").agg(F.max("k")).collect())
    table = [(r, k, heads[i - 1][0]) for i, (r, k) in enumerate(heads)]
    first = F.broadcast(spark.createDataFrame(table or [(0, 0, 0)], "_r int, _head bigint, _before int"))
    placed = df.withColumn("k", F.col(key).cast("bigint")).withColumn("_run0", run.cast("int")).join(
        first, (F.col("_run0") == F.col("_r")) & F.col("k").eqNullSafe(F.col("_head")), "left")
    copies = F.when(F.col("_r").isNull(), F.array(F.struct(F.col("_run0").alias("run"), F.lit(False).alias("halo")))).otherwise(
        F.array(F.struct(F.col("_run0").alias("run"), F.lit(False).alias("halo")),
                F.struct(F.col("_before").alias("run"), F.lit(True).alias("halo"))))
    return (placed.withColumn("_c", F.explode(copies))
            .select(*df.columns, F.col("_c.run").alias("_run"), F.col("_c.halo").alias("_halo")))


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text and of its edited text (the last half of its code points replaced by the
    first as many of the next document, descending doc_id, null doc_id last, ties by text), and how alike
    they are. Repeated rows follow each other; a lone document is its own next."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    laid = in_descending_runs(base).repartition("_run")
    order = Window.partitionBy("_run").orderBy("_halo", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = (laid.withColumn("_next", F.lead("text").over(order)).where(~F.col("_halo"))
              .withColumn("_edited", F.concat(F.col("text").substr(F.lit(1), F.length("text") - half),
                                              F.col("_next").substr(F.lit(1), half))))
    # the fingerprints come after the window: a Python step before it would cost a second shuffle of the texts
    return (edited.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
                          fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("_edited")).alias("edited_fingerprint"),
                          fingerprint(F.col("_next")).alias("_next_fp"))
            .withColumn("_e", likeness(F.col("fingerprint"), F.col("edited_fingerprint")))
            .withColumn("_n", likeness(F.col("fingerprint"), F.col("_next_fp")))
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    F.col("_e.likeness").alias("near_edited"), F.col("_n.likeness").alias("near_next"),
                    F.col("_e.a_in_b").alias("kept_in_edited"), F.col("_n.a_in_b").alias("kept_in_next")))
