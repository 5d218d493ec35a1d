"""Two tokenizers' tokens of the same bytes aligned, and how often their ids stand for each other.

Tokenizer A is a byte-level BPE, B a piece model; both cut the same bytes (the text after one space). A byte offset where
both a token of A and one of B end is a shared cut; the shared cuts split the two token sequences into groups.

Groups are found by divide and conquer: an interval of tokens (ends shared on both sides) looks for a common end near its
middle, bisecting B's ends for A's; found, it falls into two halves that do the same, and an interval without an inner cut
is a leaf, one group. All intervals of a batch of texts advance together, and the search around the middle widens by
doubling, so a batch needs O(log n) steps of numpy.

Links are all pairs of a token of A and a token of B in one group; a pair of ids counts the documents that hold it linked.
``link_statistics`` is two passes over blocks of documents (about ``BLOCK_BYTES`` of text, never less than one document):
1. each block is tokenised and aligned once and written as a row: its distinct id pairs, in how many of its documents
   each stands, and per document the pairs' places and how often they are linked;
2. the blocks' pair counts are summed; every block fetches the counts of its own pairs by a join on the pair (a pair
   stands once in a block, so a frequent pair costs a row per block, not per link) and finishes its documents.

The vocabularies' files are parameters and are sent to the tasks. A's ids are those of the tokenizers library. Where the file's
merges allow it (each merge makes the next id, each entry is made of itself alone), texts of Latin letters and common
signs go through tiktoken over the same entries, which then cuts alike and is faster; all others through the library.

Defined results: a text that is null or empty, or whose tokens' bytes of A or B differ from the space and the text, has
no tokens: zeros and an empty ``groups_sha256``; repeated rows are documents of their own; a null doc_id stays null;
an empty table gives no rows; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.packing import PATTERN
from candlewick.llm.text import slices
from candlewick.session import write_and_read

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
TEXT_BYTES = 2 << 20           # text tokenised at a time
BLOCK_BYTES = 16 << 20         # text of a block
PRODUCT = 1 << 12              # groups of more links are counted by distinct ids first
_SPLIT = 1 << 16               # a pair is a * _SPLIT + b
_LIBRARY = re.compile("[^\x00-ɏ‐-‧€]")

ALIGNED = "struct<a: array<int>, b: array<int>, a_counts: array<int>, b_counts: array<int>>"
BLOCK = ("block string, pairs array<bigint>, held array<int>, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
         "n_links array<bigint>, groups_sha256 array<string>, links binary")
STATISTICS = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of a byte-level vocabulary: visible Latin-1 characters stand for themselves, the others for U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class _Bytes:
    """The bytes that each id stands for."""

    def __init__(self, entries: list[bytes]):
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(e) for e in entries])]).astype(np.int64)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.at[ids + 1] - self.at[ids])

    def join(self, ids: np.ndarray) -> np.ndarray:
        size = self.at[ids + 1] - self.at[ids]
        end = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.arange(end[-1]) + np.repeat(self.at[ids] - end[:-1], size)]


class Coders:
    """Both tokenizers, made in each worker from the files' contents."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        import tiktoken
        from sentencepiece import sentencepiece_model_pb2 as pb
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # a task has one core
        self.library = Tokenizer.from_str(a_file.decode())
        self.library.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        proto = pb.ModelProto()
        proto.ParseFromString(b_file)
        kinds = pb.ModelProto.SentencePiece
        self.b = _Bytes([bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else p.piece.replace("▁", " ").encode() for p in proto.pieces])
        spec, alphabet = json.loads(a_file)["model"], byte_alphabet()
        entries = [b""] * (1 + max(spec["vocab"].values()))
        for entry, i in spec["vocab"].items():
            entries[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        self.a = _Bytes(entries)
        self.fast = None
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["merges"]]
        made = {e: i for e, i in spec["vocab"].items() if len(e) == 1 or 256 <= i < 256 + len(merges)}
        if all(made.get(x + y) == 256 + i for i, (x, y) in enumerate(merges)) and len(made) == 256 + len(merges):
            cut = self.library.model.tokenize
            if all(len(cut(e)) == 1 for e in made):
                self.fast = tiktoken.Encoding("alignment", pat_str=PATTERN, special_tokens={}, mergeable_ranks={entries[i]: i for i in made.values()})

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Ids of A (of the text after a space) and of B, per text."""
        spaced = [" " + t for t in texts]
        a: list = [self.fast.encode_ordinary(t) if self.fast is not None and not _LIBRARY.search(t) else None for t in spaced]
        rest = [i for i, ids in enumerate(a) if ids is None]
        for i, e in zip(rest, self.library.encode_batch_fast([spaced[i] for i in rest], add_special_tokens=False), strict=True):
            a[i] = e.ids
        return a, self.pieces.encode(texts, num_threads=1)


def _near_middle(a: np.ndarray, b: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per interval of A's tokens: the inner end nearest the middle that also is an end of B (index in A, in B), or -1."""
    middle, last = (first + stop - 2) >> 1, stop - 2
    at, other = np.full(len(first), -1, np.int64), np.full(len(first), -1, np.int64)
    open_ = np.flatnonzero(last >= first)
    done, width = -1, 0                                       # distances up to ``done`` have been looked at
    while len(open_):
        m = middle[open_]
        lo, hi = np.maximum(first[open_], m - width), np.minimum(last[open_], m + width)
        inner_lo, inner_hi = np.maximum(m - done, lo), np.minimum(m + done, hi)
        left, right = (np.maximum(inner_lo - lo, 0), np.maximum(hi - inner_hi, 0)) if done >= 0 else (np.ones(len(m), np.int64), np.zeros(len(m), np.int64))
        size = left + right
        row = np.repeat(np.arange(len(m)), size)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        cand = np.where(k < left[row], lo[row] + k, inner_hi[row] + 1 + k - left[row])
        j = np.searchsorted(b, a[cand])
        hit = b[np.minimum(j, len(b) - 1)] == a[cand]
        row, cand, j = row[hit], cand[hit], j[hit]
        if len(row):
            order = np.lexsort((np.abs(cand - m[row]), row))
            row, cand, j = row[order], cand[order], j[order]
            new = np.concatenate([[True], row[1:] != row[:-1]])
            at[open_[row[new]]], other[open_[row[new]]] = cand[new], j[new]
        more = (at[open_] < 0) & ((m - width > first[open_]) | (m + width < last[open_]))
        open_ = open_[more]
        done, width = width, 2 * width + 1
    return at, other


def align(a: np.ndarray, b: np.ndarray, a_off: np.ndarray, b_off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of texts whose tokens' ends are ``a`` and ``b`` (increasing over all texts; text t holds a_off[t]:a_off[t + 1],
    and both its last ends are equal): the first token of each group in A and in B, in order, closed by the totals."""
    some = np.flatnonzero(np.diff(a_off))
    first, stop, b_first, b_stop = a_off[some], a_off[some + 1], b_off[some], b_off[some + 1]
    leaf_a, leaf_b = [], []
    while len(first):
        i, j = _near_middle(a, b, first, stop)
        leaf = i < 0
        leaf_a.append(first[leaf])
        leaf_b.append(b_first[leaf])
        go = ~leaf
        i, j = i[go] + 1, j[go] + 1
        first, stop = np.concatenate([first[go], i]), np.concatenate([i, stop[go]])
        b_first, b_stop = np.concatenate([b_first[go], j]), np.concatenate([j, b_stop[go]])
    ga = np.concatenate([*leaf_a, [a_off[-1]]]).astype(np.int64)
    gb = np.concatenate([*leaf_b, [b_off[-1]]]).astype(np.int64)
    order = np.argsort(ga, kind="stable")
    return ga[order], gb[order]


class Aligned:
    """Ids and groups of a batch of texts."""

    def __init__(self, coders: Coders, texts: list[str | None], data: np.ndarray, off: np.ndarray):
        some = [i for i, t in enumerate(texts) if t]
        a, b = coders.encode([texts[i] for i in some])
        ids_a, ids_b = [], []
        self.n_a, self.n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for i, x, y in zip(some, a, b, strict=True):
            x, y = np.array(x, np.int64), np.array(y, np.int64)
            want = np.concatenate([[np.uint8(0x20)], data[off[i]:off[i + 1]]])
            if all(np.array_equal(c.join(ids), want) and (c.at[ids + 1] > c.at[ids]).all() for c, ids in ((coders.a, x), (coders.b, y))):
                ids_a.append(x)
                ids_b.append(y)
                self.n_a[i], self.n_b[i] = len(x), len(y)
        empty = [np.empty(0, np.int64)]
        self.a, self.b = np.concatenate(ids_a or empty), np.concatenate(ids_b or empty)
        self.a_off, self.b_off = np.concatenate([[0], np.cumsum(self.n_a)]), np.concatenate([[0], np.cumsum(self.n_b)])
        self.group_a, self.group_b = align(coders.a.ends(self.a), coders.b.ends(self.b), self.a_off, self.b_off)
        self.group_off = np.searchsorted(self.group_a[:-1], self.a_off)       # groups of each text
        self.in_a, self.in_b = np.diff(self.group_a), np.diff(self.group_b)

    def link_counts(self) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(self.in_a * self.in_b)])
        return np.diff(total[self.group_off])

    def _ids(self, sequence: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        group = np.repeat(np.arange(len(first)), size)
        return group, sequence[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times linked) of the distinct pairs of each text, by text and pair."""
        text = np.repeat(np.arange(len(self.n_a)), np.diff(self.group_off))
        first_a, in_a, first_b, in_b = self.group_a[:-1], self.in_a, self.group_b[:-1], self.in_b
        wide = in_a * in_b > PRODUCT
        row, pair, times = [], [], []
        for g in np.flatnonzero(wide).tolist():                              # rare: long stretches without a shared cut
            x, nx = np.unique(self.a[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
            y, ny = np.unique(self.b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
            pair.append((x[:, None] * _SPLIT + y[None, :]).ravel())
            times.append((nx[:, None] * ny[None, :]).ravel())
            row.append(np.full(len(pair[-1]), text[g]))
        g = np.flatnonzero(~wide)
        size = in_a[g] * in_b[g]
        which = np.repeat(g, size)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        pair.append(self.a[first_a[which] + k // in_b[which]] * _SPLIT + self.b[first_b[which] + k % in_b[which]])
        row.append(text[which])
        times.append(np.ones(len(which), np.int64))
        row, pair, times = np.concatenate(row), np.concatenate(pair), np.concatenate(times)
        key = (row << 32) | pair
        if not wide.any():
            key, times = np.unique(key, return_counts=True)
        else:
            key, back = np.unique(key, return_inverse=True)
            times = np.bincount(back, times, len(key)).astype(np.int64)
        return key >> 32, key & 0xFFFFFFFF, times

    def digests(self, names: list[bytes]) -> list[str]:
        """sha256 of ``a1,a2|b1;...`` per text (empty without tokens). ``names``: 4 * id + sign -> the id and that sign."""
        at_a = np.arange(len(self.a)) + np.repeat(self.group_b[:-1], self.in_a)
        at_b = np.arange(len(self.b)) + np.repeat(self.group_a[1:], self.in_b)
        key = np.empty(len(self.a) + len(self.b), np.int64)
        key[at_a], key[at_b] = 4 * self.a, 4 * self.b
        key[at_a[self.group_a[1:] - 1]] += 1                                 # last of A in a group: |
        key[at_b[self.group_b[1:] - 1]] += 2                                 # last of B: ;
        off = self.a_off + self.b_off
        ended = off[1:][np.diff(off) > 0] - 1
        key[ended] += 1                                                      # last of a text: nothing
        parts = list(map(names.__getitem__, key.tolist()))
        return [hashlib.sha256(b"".join(parts[s:e])).hexdigest() if e > s else "" for s, e in zip(off[:-1].tolist(), off[1:].tolist())]


def signed_names(n: int) -> list[bytes]:
    return [b"%d%s" % (i, s) for i in range(n) for s in (b",", b"|", b";", b"")]


def _load(spark, a_path: str, b_path: str):
    files = []
    for p in (a_path, b_path):
        with open(p, "rb") as f:
            files.append(f.read())
    return spark.sparkContext.broadcast(tuple(files))         # two vocabulary files of a few MB


def with_alignment(df: DataFrame, text: str = "text", out: str = "alignment", a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """``df`` with the ids of both tokenizers and, group by group, how many of each belong to it."""
    if out in df.columns:
        raise ValueError(f"the column {out} exists already")
    shared, cell = _load(df.sparkSession, a_path, b_path), []

    @F.arrow_udf(ALIGNED)
    def udf(arr: pa.Array) -> pa.Array:
        if not cell:
            cell.append(Coders(*shared.value))
        parts: list[list[np.ndarray]] = [[] for _ in range(4)]
        offs = [[np.zeros(1, np.int64)] for _ in range(4)]
        for lo, hi, data, off in slices(arr, TEXT_BYTES):
            got = Aligned(cell[0], arr.slice(lo, hi - lo).to_pylist(), data, off)
            for p, o, v, at in zip(parts, offs, (got.a, got.b, got.in_a, got.in_b), (got.a_off, got.b_off, got.group_off, got.group_off)):
                p.append(v)
                o.append(at[1:] + o[-1][-1])
        lists = [pa.ListArray.from_arrays(pa.array(np.concatenate(o), pa.int32()), pa.array(np.concatenate(p or [np.empty(0)]).astype(np.int32)))
                 for p, o in zip(parts, offs)]
        return pa.StructArray.from_arrays(lists, ["a", "b", "a_counts", "b_counts"])
    return df.withColumn(out, udf(F.col(text)))


class _Block:
    """Documents gathered into one block row."""

    def __init__(self) -> None:
        self.size, self.n = 0, 0
        self.columns: list[list] = [[] for _ in range(6)]
        self.row, self.pair, self.times = [], [], []

    def add(self, keys: list, got: Aligned, names: list[bytes], size: int) -> None:
        row, pair, times = got.links()
        for c, v in zip(self.columns, (keys, got.n_a.tolist(), got.n_b.tolist(), np.diff(got.group_off).tolist(), got.link_counts().tolist(),
                                       got.digests(names)), strict=True):
            c += v
        self.row.append(row + self.n)
        self.pair.append(pair)
        self.times.append(times)
        self.n += len(keys)
        self.size += size

    def batch(self) -> pa.RecordBatch:
        pairs, at = np.unique(np.concatenate(self.pair), return_inverse=True)
        count = np.bincount(np.concatenate(self.row), minlength=self.n)
        step = np.diff(at, prepend=0)                                        # pairs go up within a document: small steps
        raw = np.concatenate([[self.n, len(at)], count, step, np.concatenate(self.times)]).astype("<i8")
        big = np.abs(raw).max(initial=0) >= 1 << 31
        packed = (b"8" if big else b"4") + raw.astype("<i8" if big else "<i4").tobytes()
        body = len(packed).to_bytes(8, "little") + pa.Codec("zstd").compress(packed, asbytes=True)
        held = np.bincount(at, minlength=len(pairs))
        types = [pa.int64()] * 5 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), pa.array([pairs], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.int32())),
             *[pa.array([c], pa.list_(t)) for c, t in zip(self.columns, types)], pa.array([body], pa.binary())],
            [f.split()[0] for f in BLOCK.split(", ")])


def _unpack(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs of each document, places of the pairs, times linked)."""
    packed = pa.Codec("zstd").decompress(body[8:], int.from_bytes(body[:8], "little"), asbytes=True)
    raw = np.frombuffer(packed, "<i8" if packed[:1] == b"8" else "<i4", offset=1).astype(np.int64)
    n, m = raw[:2].tolist()
    return raw[2:2 + n], np.cumsum(raw[2 + n:2 + n + m]), raw[2 + n + m:]


def blocks(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Pass 1: a row per block of documents (doc_id, text)."""
    shared = _load(docs.sparkSession, a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = names = None
        block = _Block()
        for b in batches:
            if coders is None:
                coders = Coders(*shared.value)
                names = signed_names(max(len(coders.a.at), len(coders.b.at)) - 1)
            keys = b.column("doc_id").to_pylist()
            for lo, hi, data, off in slices(b.column("text"), TEXT_BYTES):
                block.add(keys[lo:hi], Aligned(coders, b.column("text").slice(lo, hi - lo).to_pylist(), data, off), names, len(data))
                if block.size >= block_bytes:
                    yield block.batch()
                    block = _Block()
        if block.n:
            yield block.batch()
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, BLOCK)


def pair_counts(table: DataFrame) -> DataFrame:
    """Documents that hold each id pair linked (``held``), and whether no pair of its A id has more (``best``). One row per
    distinct pair, at most the product of the vocabularies; an A id has at most as many rows as B has ids."""
    held = (table.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).groupBy(F.col("p.pairs").alias("pair"))
            .agg(F.sum(F.col("p.held").cast("bigint")).alias("held")).withColumn("a", F.shiftright("pair", 16)))
    top = held.groupBy("a").agg(F.max("held").alias("most"))
    return held.join(top, "a").select("pair", "held", (F.col("held") == F.col("most")).alias("best"))


def link_statistics(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: tokens, groups and links, how many links are their A id's most frequent, the links' summed counts."""
    table = write_and_read(blocks(docs, a_path, b_path, block_bytes), "alignment-blocks")
    counts = write_and_read(pair_counts(table), "alignment-counts")
    asked = table.select("block", F.posexplode("pairs").alias("at", "pair"))
    known = (asked.join(counts, "pair").groupBy("block")
             .agg(F.array_sort(F.collect_list(F.struct("at", "held", "best"))).alias("known")))    # a block's own pairs, once each
    rows = table.drop("pairs", "held").join(
        known.select("block", F.transform("known", lambda k: k["held"]).alias("held"), F.transform("known", lambda k: k["best"]).alias("best")),
        "block", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                count, at, times = _unpack(b.column("links")[i].as_py())
                n = len(count)
                held = b.column("held")[i].values if b.column("held")[i].is_valid else None
                if held is None:
                    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
                else:
                    held = held.to_numpy(zero_copy_only=False)
                    top = b.column("best")[i].values.to_numpy(zero_copy_only=False).astype(bool)
                    size = np.concatenate([[0], np.cumsum(count)])
                    best, total = (np.diff(np.concatenate([[0], np.cumsum(v)])[size]) for v in (times * top[at], times * held[at]))
                own = {f: b.column(f)[i].values for f in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
                yield pa.RecordBatch.from_arrays([own["doc_id"], own["n_a"], own["n_b"], own["n_groups"], own["n_links"], pa.array(best, pa.int64()),
                                                  pa.array(total, pa.int64()), own["groups_sha256"]], [f.split()[0] for f in STATISTICS.split(", ")])
    return rows.mapInArrow(finish, STATISTICS)
