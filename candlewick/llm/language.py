"""Language identification by prediction by partial matching (PPM) over bytes.

For each language a context tree of up to ``ORDER`` bytes holds how often each byte followed each context.
A byte's probability blends the orders by escape probabilities (method C: with n observations and d
distinct bytes in a context, the escape has d / (n + d)), down to a uniform law. The statistics are frozen
after training, so the code length of (context, byte) is a constant: the trees of all languages are
flattened once into one table of bits per (context state, byte, language), and a text's exact code length
is the sum over its bytes. A context state is the longest suffix of the last bytes that the tree holds.

Bytes are lower-cased (ASCII and Latin-1 letters) and mapped to at most ``SYMBOLS`` - 1 frequent bytes plus
one symbol for all others, so the table has a fixed size. Counting runs on Spark over a bounded sample per
language; scoring runs over whole texts in Arrow batches.

Defined results: a null text or one without a letter is ``und`` with score 0; without learnable rows every
text is ``und``; a null doc_id is not learned from and not held out. The score is the share of the best
language in a softmax of the mean code lengths (``SHARPNESS`` bytes' worth of evidence).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import lower, slices

ORDER = 3
SYMBOL_BITS = 6
SYMBOLS = 1 << SYMBOL_BITS
SHARPNESS = 32.0
MOST_DOCS = 1_500         # sampled documents per language, in expectation (a documented bound)
LEAST_SEEN = 4            # a context seen fewer times is not a state of its own
HELD_OUT = 2


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def codes(data: np.ndarray, off: np.ndarray, symbol: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(symbol of each byte, packed last ``order`` symbols before it); 0 stands before a text's start."""
    s = symbol[lower(data)].astype(np.int32)
    context = np.zeros(len(s), np.int32)
    inside = np.arange(len(s)) - np.repeat(off[:-1], np.diff(off))
    for k in range(1, order + 1):
        part = np.zeros(len(s), np.int32)
        part[k:] = s[:-k] << (SYMBOL_BITS * (k - 1))
        part[inside < k] = 0
        context |= part
    return s, context


def sample(docs: DataFrame, most: int = MOST_DOCS) -> DataFrame:
    """(lang, text) of rows that may be learned from, about ``most`` per language by a hash of doc_id."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    n = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}     # one row per language
    share = F.lit(0)
    for lang, count in n.items():
        share = F.when(F.col("lang") == lang, F.lit(int((1 << 30) * min(1.0, most / count)))).otherwise(share)
    return known.where(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30)) < share).select("lang", "text")


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, np.int64)
    for b in batches:
        for _, _, data, _ in slices(b.column("text")):
            total += np.bincount(lower(data), minlength=256)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["byte", "n"])


def _gram_counter(symbol: np.ndarray, langs: list[str], order: int):
    index = {v: i for i, v in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << (SYMBOL_BITS * (order + 1))
        for b in batches:
            lang = np.array([index[v] for v in b.column("lang").to_pylist()], np.int64)
            for lo, hi, data, off in slices(b.column("text")):
                s, c = codes(data, off, symbol, order)
                key = (np.repeat(lang[lo:hi], np.diff(off)) * size) + ((c.astype(np.int64) << SYMBOL_BITS) | s)
                got, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(got), pa.array(n)], ["key", "n"])
    return count


class Model:
    """Flattened trees: ``state`` of each packed context, ``bits`` of (state, symbol, language)."""

    def __init__(self, langs: list[str], symbol: np.ndarray, state: np.ndarray, bits: np.ndarray, order: int = ORDER):
        self.langs, self.symbol, self.state, self.bits, self.order = langs, symbol, state, bits, order

    def lengths(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(code length in bits per text and language, bytes per text)."""
        parts, sizes = [], []
        for _, _, data, off in slices(arr):
            n = len(off) - 1
            s, c = codes(data, off, self.symbol, self.order)
            at = self.state[c] * SYMBOLS + s
            out = np.zeros((n, len(self.langs)))
            has = np.flatnonzero(np.diff(off) > 0)
            for i in range(len(self.langs)):
                if len(has):
                    out[has, i] = np.add.reduceat(self.bits[i][at], off[:-1][has], dtype=np.float64)
            parts.append(out)
            sizes.append(np.diff(off))
        if not parts:
            return np.zeros((0, len(self.langs))), np.zeros(0, np.int64)
        return np.concatenate(parts), np.concatenate(sizes)


def build(langs: list[str], symbol: np.ndarray, counts: dict[int, tuple[np.ndarray, np.ndarray]],
          order: int = ORDER, least: int = LEAST_SEEN) -> Model:
    """Trees from per-language counts of packed (context, symbol) grams of the highest order."""
    contexts = 1 << (SYMBOL_BITS * order)
    per_order: list[list[tuple]] = []
    for i in range(len(langs)):
        key, n = counts.get(i, (np.empty(0, np.int64), np.empty(0, np.int64)))
        context, s = key >> SYMBOL_BITS, key & (SYMBOLS - 1)
        levels = []
        for k in range(order + 1):
            low = context & ((1 << (SYMBOL_BITS * k)) - 1)
            gram, inv = np.unique((low << SYMBOL_BITS) | s, return_inverse=True)
            levels.append((gram, np.bincount(inv, n, len(gram)).astype(np.int64)))
        per_order.append(levels)
    # union of the languages' contexts that are seen often enough: state 0 is the empty context
    state = np.zeros(contexts, np.int32)
    suffix = [np.zeros(1, np.int64)]
    first = 1
    every = np.arange(contexts)
    for k in range(1, order + 1):
        seen = np.zeros(1 << (SYMBOL_BITS * k), np.int64)
        for levels in per_order:
            seen += np.bincount(levels[k][0] >> SYMBOL_BITS, levels[k][1], len(seen)).astype(np.int64)
        own = np.flatnonzero(seen >= least)
        number = np.full(len(seen), -1, np.int32)
        number[own] = first + np.arange(len(own))
        first += len(own)
        suffix.append(own)
        got = number[every & (len(seen) - 1)]
        state = np.where(got >= 0, got, state)
    bits = []
    for levels in per_order:
        law = np.full((1, SYMBOLS), 1.0 / SYMBOLS)
        rows = []
        for k in range(order + 1):
            own = suffix[k]
            if k:      # the shorter context's law: drop the oldest symbol
                shorter = own & ((1 << (SYMBOL_BITS * (k - 1))) - 1)
                law = rows[k - 1][np.searchsorted(suffix[k - 1], shorter)]
            gram, n = levels[k]
            at = np.searchsorted(own, gram >> SYMBOL_BITS)
            ok = (at < len(own)) & (own[np.minimum(at, len(own) - 1)] == gram >> SYMBOL_BITS) if len(own) else np.zeros(len(gram), bool)
            table = np.zeros((len(own), SYMBOLS))
            table[at[ok], (gram & (SYMBOLS - 1))[ok]] = n[ok]
            total, kinds = table.sum(1, keepdims=True), (table > 0).sum(1, keepdims=True)
            with np.errstate(invalid="ignore", divide="ignore"):
                mixed = (table + kinds * law) / (total + kinds)
            rows.append(np.where(total > 0, mixed, law))
        bits.append((-np.log2(np.concatenate(rows))).astype(np.float32).ravel())
    return Model(langs, symbol, state, np.stack(bits) if bits else np.zeros((0, 0), np.float32), order)


def train(docs: DataFrame, most: int = MOST_DOCS, order: int = ORDER) -> Model:
    rows = sample(docs, most)
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    by_byte = {r[0]: r[1] for r in rows.mapInArrow(_byte_counts, "byte bigint, n bigint").groupBy("byte").agg(F.sum("n")).collect()}
    frequent = sorted((b for b in by_byte if by_byte[b]), key=lambda b: (-by_byte[b], b))[:SYMBOLS - 2]
    symbol = np.full(256, SYMBOLS - 1, np.uint8)       # 0: before the text; the last: any other byte
    symbol[frequent] = np.arange(1, len(frequent) + 1)
    grams = (rows.mapInArrow(_gram_counter(symbol, langs, order), "key bigint, n bigint")
             .groupBy("key").agg(F.sum("n").alias("n")).toArrow())
    key, n = grams.column(0).to_numpy(), grams.column(1).to_numpy()
    size = 1 << (SYMBOL_BITS * (order + 1))
    counts = {i: (key[key // size == i] % size, n[key // size == i]) for i in range(len(langs))}
    return build(langs, symbol, counts, order)


def predict(text: Column, model: Model, spark) -> Column:
    """struct(lang, score, bits_per_byte)."""
    shared = spark.sparkContext.broadcast(model)
    letter = text.rlike(r"\p{L}")

    @F.arrow_udf("struct<lang: string, score: double, bits_per_byte: double>")
    def udf(t: pa.Array, has: pa.Array) -> pa.Array:
        m = shared.value
        length, size = m.lengths(t)
        ok = has.fill_null(False).to_numpy(zero_copy_only=False) & (size > 0) & (len(m.langs) > 0)
        mean = length / np.maximum(size, 1)[:, None] if len(m.langs) else np.zeros((len(size), 1))
        best = mean.argmin(1) if len(mean) else np.zeros(0, int)
        least = mean.min(1) if len(mean) else np.zeros(0)
        share = 1.0 / np.exp2(-(mean - least[:, None]) * np.minimum(SHARPNESS, np.maximum(size, 1))[:, None]).sum(1)
        lang = [m.langs[i] if o else "und" for i, o in zip(best, ok, strict=True)]
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(np.where(ok, share, 0.0)),
                                           pa.array(np.where(ok, least, 8.0))], ["lang", "score", "bits_per_byte"])
    return udf(text, F.coalesce(letter, F.lit(False)))


def with_language(df: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``df`` with the struct of :func:`predict`."""
    return df.withColumn(out, predict(F.col(text), model, df.sparkSession))
