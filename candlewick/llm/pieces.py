"""SentencePiece encoding and decoding with a batched numpy Viterbi.

Pieces and scores come from a public model file (a parameter). A text is segmented into the pieces of
highest total score; pieces never run from a visible character into a space, so words (spaces, then
visible characters) are segmented on their own, each distinct word once per batch. Words of equal length
advance together: substrings are hashed from prefix hashes, the hashes probe the sorted hashes of the
pieces, and the maxima over the piece lengths ending at a position store that position's backpointer.
A character without a piece is written as its UTF-8 byte pieces and costs 10 below the lowest score. Sums
are exact (64-bit); among equal sums the longest last piece wins.

Only identity normalisation (with the added leading space) is supported; other model files are refused.

Defined results: a null or empty text has no ids and decodes to the empty text; every text, whatever its
characters, decodes to itself; ids that are null, control pieces or outside the vocabulary decode to nothing, a null array
to the empty text. ``encode`` and ``decode`` replace a column named like their output.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import U, slices
from candlewick.llm.words import WordCache

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
LONGEST_TOGETHER = 48          # longer words are segmented one by one
TEXT_BYTES = 1 << 20           # text that a worker holds as words at a time
_WORD = re.compile(r" *[^ ]+| +")
_B = 0x9E3779B97F4A7C15
_NORMAL, _CONTROL, _BYTE = 1, 3, 6


class Vocabulary:
    """Sorted piece hashes with scores and ids, and the bytes each id stands for."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        normal = [(p, s, i) for i, (p, s, kind) in enumerate(pieces) if kind == _NORMAL]
        if any(" " in p or "▁" in p.lstrip("▁") for p, _, _ in normal):
            raise ValueError("a piece continues after an inner space: words can't be segmented alone")
        codes = [np.array([ord(c) for c in p.replace("▁", " ")], U) for p, _, _ in normal]
        with np.errstate(over="ignore"):
            hashes = np.array([int(self.fold(c[None, :])[-1][0]) for c in codes], U)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces share a hash")
        self.scores = np.array([s for _, s, _ in normal], float)[order]
        self.ids = np.array([i for _, _, i in normal], np.int32)[order]
        self.longest = max((len(c) for c in codes), default=1)
        self.unknown = float(min((s for _, s, _ in normal), default=0.0)) - 10.0
        self.maybe = np.zeros(1 << 20, bool)          # leading hash bits that some piece has
        self.maybe[(self.keys >> U(44)).astype(np.int64)] = True
        self.byte_ids = np.full(256, -1, np.int32)
        text = []
        for i, (p, _, kind) in enumerate(pieces):
            if kind == _BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
                text.append(bytes([int(p[3:5], 16)]))
            else:
                text.append(p.replace("▁", " ").encode() if kind == _NORMAL else b"")
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        self.piece_bytes = np.frombuffer(b"".join(text), np.uint8)
        self.piece_at = np.concatenate([[0], np.cumsum([len(t) for t in text])])
        self.power = np.ones(self.longest + 1, U)
        with np.errstate(over="ignore"):
            self.power[1:] = np.cumprod(np.full(self.longest, _B, U), dtype=U)

    @staticmethod
    def load(path: str = MODEL_PATH) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2 as pb
        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        n = m.normalizer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or not n.escape_whitespaces:
            raise ValueError("only identity normalisation with a leading space is supported")
        return Vocabulary([(p.piece, p.score, p.type) for p in m.pieces])

    @staticmethod
    def fold(codes: np.ndarray) -> list[np.ndarray]:
        """Prefix hashes (one array per position) of rows of code points."""
        out = [np.zeros(len(codes), U)]
        with np.errstate(over="ignore"):
            for j in range(codes.shape[1]):
                out.append(out[-1] * U(_B) + codes[:, j] + U(1))
        return out

    def probe(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score, id) of each hash; -inf and -1 where no piece has it."""
        score, ids = np.full(h.shape, -np.inf), np.full(h.shape, -1, np.int32)
        some = np.flatnonzero(self.maybe[(h >> U(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
        ok = self.keys[at] == h[some]
        score[some[ok]], ids[some[ok]] = self.scores[at[ok]], self.ids[at[ok]]
        return score, ids

    def segment(self, words: list[str]) -> list[np.ndarray]:
        """Piece ids of each word (word: spaces, then visible characters)."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for n, rows in by_length.items():
            if n == 0:
                continue
            if n > LONGEST_TOGETHER:
                for i in rows:
                    out[i] = self._alone(words[i])
                continue
            text = np.array([words[i] for i in rows], f"<U{n}")
            codes = text.view(np.uint32).reshape(len(rows), n).astype(U)
            self._together(codes, rows, [words[i] for i in rows], out)
        return out

    def _together(self, codes: np.ndarray, rows: list[int], words: list[str], out: list[np.ndarray]) -> None:
        m, n = codes.shape
        prefix = self.fold(codes)
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0.0
        back, piece = np.zeros((n + 1, m), np.int64), np.full((n + 1, m), -1, np.int32)
        for end in range(1, n + 1):
            for size in range(min(end, self.longest), 0, -1):
                start = end - size
                with np.errstate(over="ignore"):
                    score, ids = self.probe(prefix[end] - prefix[start] * self.power[size])
                if size == 1:
                    score = np.where(ids < 0, self.unknown, score)
                total = best[start] + score
                better = total > best[end]
                best[end][better], back[end][better], piece[end][better] = total[better], start, ids[better]
        end = np.full(m, n)
        steps = []
        every = np.arange(m)
        while end.any():
            steps.append((np.where(end > 0, piece[end, every], -2), back[end, every]))
            end = np.where(end > 0, back[end, every], 0)
        got = np.stack([s[0] for s in steps[::-1]], 1)
        start = np.stack([s[1] for s in steps[::-1]], 1)
        unknown = (got == -1).any(1)
        used = got != -2
        at = np.concatenate([[0], np.cumsum(used.sum(1))])
        flat = got[used]
        for j, i in enumerate(rows):
            out[i] = flat[at[j]:at[j + 1]] if not unknown[j] else self._bytes(words[j], got[j][used[j]], start[j][used[j]])

    def _alone(self, word: str) -> np.ndarray:
        n = len(word)
        codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
        run = list(accumulate(codes.tolist(), lambda h, c: (h * _B + c + 1) & (2 ** 64 - 1), initial=0))
        prefix = np.array(run, U)
        scores, pieces = [], []
        for size in range(1, min(n, self.longest) + 1):
            with np.errstate(over="ignore"):
                s, i = self.probe(prefix[size:] - prefix[:-size] * self.power[size])
            if size == 1:
                s = np.where(i < 0, self.unknown, s)
            scores.append(s.tolist())
            pieces.append(i)
        best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        sizes = range(len(scores), 0, -1)
        for end in range(1, n + 1):
            top, frm = -np.inf, 0
            for size in sizes:
                start = end - size
                if start >= 0:
                    total = best[start] + scores[size - 1][start]
                    if total > top:
                        top, frm = total, start
            best[end], back[end] = top, frm
        end, cuts = n, []
        while end:
            cuts.append((back[end], end))
            end = back[end]
        cuts.reverse()
        start = np.array([a for a, _ in cuts])
        ids = np.array([pieces[b - a - 1][a] for a, b in cuts], np.int32)
        return self._bytes(word, ids, start) if (ids < 0).any() else ids

    def _bytes(self, word: str, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
        out = []
        for i, a in zip(ids.tolist(), start.tolist(), strict=True):
            out += [i] if i >= 0 else self.byte_ids[list(word[a].encode("utf-8"))].tolist()
        return np.array(out, np.int32)


class Encoder:
    """Encodes and decodes batches; keeps the segmentation of recent words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.words = vocabulary, WordCache(vocabulary.segment)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets)."""
        words: list[str] = []
        count = [0]
        for t in texts:
            if t:
                words += _WORD.findall(" " + t)
            count.append(len(words))
        ids, off = self.words.lookup(words)
        return ids, off[np.array(count)]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes, offsets) of rows of ids, without each row's added leading space."""
        at = self.v.piece_at
        known = (ids >= 0) & (ids < len(at) - 1)
        i = np.where(known, ids, 0)
        size = np.where(known, at[i + 1] - at[i], 0)
        end = np.concatenate([[0], np.cumsum(size)])
        raw = self.v.piece_bytes[np.arange(end[-1]) + np.repeat(at[i] - end[:-1], size)]
        off = end[off]
        lead = off[:-1][np.diff(off) > 0]
        lead = lead[raw[lead] == 0x20]
        keep = np.ones(len(raw), bool)
        keep[lead] = False
        gone = np.concatenate([[0], np.cumsum(~keep)])
        return raw[keep], off - gone[off]


def _texts(arr: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    yield from slices(arr, TEXT_BYTES)


def encode(df: DataFrame, text: str = "text", out: str = "ids", path: str = MODEL_PATH) -> DataFrame:
    """``df`` with the array of piece ids of ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    cell: list[Encoder] = []

    @F.arrow_udf("array<int>")
    def udf(t: pa.Array) -> pa.Array:
        if not cell:
            cell.append(Encoder(shared.value))
        ids, off = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for lo, hi, _, _ in _texts(t):
            i, o = cell[0].encode(t.slice(lo, hi - lo).fill_null("").to_pylist())
            ids.append(i)
            off.append(o[1:] + off[-1][-1])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(off).astype(np.int32)), pa.array(np.concatenate(ids)))
    return df.withColumn(out, udf(F.col(text)))


def decode(df: DataFrame, ids: str = "ids", out: str = "text", path: str = MODEL_PATH) -> DataFrame:
    """``df`` with the text of an array of piece ids."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    @F.arrow_udf("string")
    def udf(a: pa.Array) -> pa.Array:
        parts = []
        coder = Encoder(shared.value)
        for row in a.to_pylist():
            known = [x for x in row or [] if x is not None]
            raw, _ = coder.decode(np.array(known, np.int64), np.array([0, len(known)]))
            parts.append(raw.tobytes().decode("utf-8", "replace"))
        return pa.array(parts, pa.string())
    return df.withColumn(out, udf(F.col(ids)))


def round_trip(text: Column, spark, path: str = MODEL_PATH) -> Column:
    """struct(n_tokens, ids_sha256, lossless): the ids of a text (as little-endian 32-bit integers) digested,
    and whether decoding them gives the text's bytes back."""
    shared = spark.sparkContext.broadcast(Vocabulary.load(path))
    cell: list[Encoder] = []

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, lossless: boolean>")
    def udf(t: pa.Array) -> pa.Array:
        if not cell:
            cell.append(Encoder(shared.value))
        n, digest, same = [], [], []
        for lo, hi, data, off in _texts(t):
            ids, o = cell[0].encode(t.slice(lo, hi - lo).fill_null("").to_pylist())
            raw, r = cell[0].decode(ids, o)
            little = ids.astype("<i4")
            n += np.diff(o).tolist()
            for k in range(hi - lo):
                digest.append(hashlib.sha256(little[o[k]:o[k + 1]].tobytes()).hexdigest())
                same.append(bool(np.array_equal(raw[r[k]:r[k + 1]], data[off[k]:off[k + 1]])))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(same, pa.bool_())],
                                          ["n_tokens", "ids_sha256", "lossless"])
    return udf(text)
