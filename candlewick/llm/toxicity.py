"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic model over its hashed words; the
document's score is their noisy-or with a leak, 1 - (1 - leak) * prod(1 - p). Only document labels are known, so the word weights
are trained through the noisy-or, and the sentence scores then say where the offence is.

Sentences end at . ! ? or a line break. The model is fitted on the driver from a bounded sample of
labelled rows (about ``MOST_LABELLED`` rows, each with its whole text);
scoring runs over whole texts in Arrow batches and needs one fixed-size weight table.

Defined results: a null, empty or wordless text has the score of a bag without sentences, the leak. Rows with a
null label or doc_id are not learned from. Without any learnable
label 1 every score is 0, without any label 0 every score is 1 (both up to 1e-13).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import U, lower, range_hashes, slices, word_bounds

BITS = 18                 # weight table of 2**18 hashed words
MOST_LABELLED = 6_000    # labelled rows the fit may see (in expectation, by hash threshold)
HELD_OUT = 2              # crc32(doc_id) mod 4 of held-out rows
CUT = 0.3

_END = np.zeros(256, bool)
_END[[0x0A, 0x0D, 0x21, 0x2E, 0x3F]] = True
_STRIP = np.ones(256, bool)
_STRIP[0x80:] = False
_STRIP[0x30:0x3A] = _STRIP[0x41:0x5B] = _STRIP[0x61:0x7B] = False


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def sentence_words(data: np.ndarray, off: np.ndarray, bits: int = BITS):
    """(bucket of each word, sentence of each word, sentence starts, sentence ends, per-row sentence offsets).

    A word is a run of letters, digits and non-ASCII bytes, lower-cased.
    """
    text = lower(data)
    ends = np.flatnonzero(_END[text]) + 1
    cuts = np.unique(np.concatenate([off, ends]))
    s_start, s_end = cuts[:-1], cuts[1:]
    text[_STRIP[text]] = 0x20
    w0, w1, _ = word_bounds(text, cuts)
    bucket = (range_hashes(text, w0, w1) >> U(64 - bits)).astype(np.int64)
    sent = np.searchsorted(cuts, w0, "right") - 1
    return bucket, sent, s_start, s_end, np.searchsorted(s_start, off)


class Model:
    """Word weights, sentence bias and leak, and the scoring of batches."""

    def __init__(self, weights: np.ndarray, bias: float, leak: float = -30.0, bits: int = BITS):
        self.weights, self.bias, self.leak, self.bits = weights.astype(np.float32), float(bias), float(leak), bits

    def sentences(self, data: np.ndarray, off: np.ndarray):
        """(probability, start, end, per-row offsets) of the sentences; one without words has 0."""
        bucket, sent, s0, s1, rows = sentence_words(data, off, self.bits)
        n = len(s0)
        told = np.unique((sent << self.bits)[w := self.weights[bucket] != 0] | bucket[w])     # a word counts once a sentence
        z = np.bincount(told >> self.bits, self.weights[told & ((1 << self.bits) - 1)], n) + self.bias
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        p[np.bincount(sent, minlength=n) == 0] = 0.0
        return p, s0, s1, rows

    def score(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: noisy-or score, highest sentence score, and that sentence's first and past-last byte."""
        parts = []
        for _, _, data, off in slices(arr):
            p, s0, s1, rows = self.sentences(data, off)
            n = len(off) - 1
            row = np.repeat(np.arange(n), np.diff(rows))
            score = 1.0 - np.exp(np.bincount(row, np.log1p(-np.minimum(p, 1 - 1e-12)), n) - np.log1p(np.exp(self.leak)))
            top, a, b = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
            order = np.lexsort((-np.arange(len(p)), p, row))       # the last of each row: highest, earliest
            has = np.diff(rows) > 0
            best = order[rows[1:][has] - 1]
            top[has], a[has], b[has] = p[best], s0[best] - off[:-1][has], s1[best] - off[:-1][has]
            parts.append((score, top, a, b))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else \
            (np.zeros(0), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))


def fit(texts: list[str] | pa.Array, labels: np.ndarray, bits: int = BITS, rounds: int = 100, rate: float = 1.0,
        l2: float = 0.03, least: int = 5, gain: float = 20.0) -> Model:
    """Adagrad descent on the document log-loss of the noisy-or with an L2 penalty; words in under ``least`` sampled documents,
    or whose presence tells the label by a likelihood ratio under ``gain``, keep weight 0."""
    size = 1 << bits
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(size), -30.0, -30.0 if not len(y) or y.max() == 0 else 30.0, bits)
    words, sents, docs, n_sent = [], [], [], 0
    for lo, hi, data, off in slices(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())):
        bucket, sent, s0, _, rows = sentence_words(data, off, bits)
        pair = np.unique((sent << bits) | bucket)                  # presence of a word in a sentence
        words.append((pair & (size - 1)).astype(np.int32))
        sents.append(((pair >> bits) + n_sent).astype(np.int32))
        docs.append(np.repeat(np.arange(lo, hi, dtype=np.int32), np.diff(rows)))
        n_sent += len(s0)
    word, sent, doc = np.concatenate(words), np.concatenate(sents), np.concatenate(docs)
    del words, sents, docs
    seen = np.unique((doc[sent].astype(np.int64) << bits) | word)
    n, k = np.bincount(seen & (size - 1), minlength=size), np.bincount(seen & (size - 1), y[seen >> bits], size)
    del seen
    base = y.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        share = k / n
        told = 2 * (np.where(k > 0, k * np.log(share / base), 0) + np.where(n > k, (n - k) * np.log((1 - share) / (1 - base)), 0))
    keep = ((n >= least) & (told >= gain))[word]
    vocab, word = np.unique(word[keep], return_inverse=True)
    sent = sent[keep]
    w, g2 = np.zeros(len(vocab)), np.full(len(vocab), 1e-8)
    n_docs = len(texts)
    # bias of a sentence, and the leak: chance of label 1 without any offending sentence
    side = np.array([np.log(max(y.mean(), 1e-4) / max(1.0, n_sent / n_docs)), np.log(max(y.mean(), 1e-4) / 2)])
    side2 = np.full(2, 1e-8)
    order = np.argsort(word, kind="stable")          # word-major, so that both passes read forward
    word, sent = word[order], sent[order]
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(np.bincount(sent, w[word], n_sent) + side[0], -30, 30)))
        q = 1.0 / (1.0 + np.exp(-side[1]))
        clean = np.exp(np.clip(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), n_docs) + np.log1p(-q), -50, -1e-9))
        # d loss / d z: p for a clean document, -p * clean / (1 - clean) for a toxic one
        pull = np.where(y > 0, -clean / (1 - clean), 1.0)
        slope = pull[doc] * p
        g = np.bincount(word, slope[sent], len(vocab)) + l2 * w
        gs = np.array([slope.sum(), (pull * q).sum()])
        g2 += g * g
        side2 += gs * gs
        w -= rate * g / np.sqrt(g2)
        side -= 0.3 * rate * gs / np.sqrt(side2)
    table = np.zeros(size)
    table[vocab] = w
    return Model(table, side[0], side[1], bits)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> tuple[pa.Array, np.ndarray]:
    """At most about ``most`` labelled texts outside the held-out fold, chosen by a hash of doc_id."""
    known = labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT)).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    total = known.count()
    if total > most:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) < int((1 << 30) * most / total))
    rows = (docs.select("doc_id", "text").join(known, "doc_id").orderBy("doc_id", F.xxhash64("text"))
            .select(F.coalesce("text", F.lit("")).alias("text"), "toxic").toArrow())
    texts = rows.column(0).combine_chunks()
    return texts.chunk(0) if isinstance(texts, pa.ChunkedArray) and texts.num_chunks else texts, rows.column(1).to_numpy()


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    return fit(*labelled_sample(docs, labels, most))


def score(text: Column, model: Model, spark) -> Column:
    """struct(score, sentence_score, start, stop): the document's score, its worst sentence's and where that
    sentence lies (UTF-8 byte range)."""
    shared = spark.sparkContext.broadcast((model.weights, model.bias, model.leak, model.bits))

    @F.arrow_udf("struct<score: double, sentence_score: double, start: bigint, stop: bigint>")
    def udf(t: pa.Array) -> pa.Array:
        cols = Model(*shared.value).score(t)
        return pa.StructArray.from_arrays([pa.array(c) for c in cols], ["score", "sentence_score", "start", "stop"])
    return udf(text)


def with_toxicity(df: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` with the struct of :func:`score`."""
    return df.withColumn(out, score(F.col(text), model, df.sparkSession))


def worst_sentence(text: Column, tox: Column) -> Column:
    """Text of the most offending sentence."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    return F.trim(F.decode(F.substring(raw, (tox["start"] + 1).cast("int"), (tox["stop"] - tox["start"]).cast("int")), "UTF-8"))
