"""Token ids packed into fixed-length rows, written as binary matrices.

Texts are tokenised with a public byte-level BPE vocabulary (its path is a parameter), an end token closes
each document, and documents are split losslessly into pieces of at most ``LENGTH`` ids. Each task packs its
stream of pieces, ``WINDOW`` ids at a time, by best-fit decreasing: the longest piece goes to the fullest row
it fits in, found in a segment tree over the free capacities. No shuffle is needed.

A packed row holds its ids padded to ``LENGTH`` (little-endian 16-bit), position ids that restart at every
piece, the cumulative piece lengths, and which part of which document each piece is. Rows are written as
Parquet binary columns: the concatenated ``ids`` of a file's rows are its (rows x LENGTH) matrix.

Defined results: a null or empty text gives one piece holding the end token alone; repeated rows are packed
each; a null doc_id stays null in ``doc_ids``; an empty table gives no rows. Which pieces share a row depends on how the
table is split into tasks (every document is whole in any case); columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import slices

VOCABULARY_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pattern that belongs to the vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_ID = 50256
LENGTH = 2048
WINDOW = 1 << 21          # ids a task packs at a time
TEXT_BYTES = 4 << 20
SCHEMA = "ids binary, positions binary, cu_seqlens array<int>, doc_ids array<bigint>, parts array<int>"

class Tokenizer:
    """Byte-level BPE ids of texts."""

    def __init__(self, ranks: bytes):
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.coder = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def ended(self, text: str, end: int) -> np.ndarray:
        """Ids of a text and the ``end`` id."""
        ids = self.coder.encode_ordinary(text)
        ids.append(end)
        return np.frombuffer(array("H", ids), np.uint16)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets)."""
        parts = [self.ended(t, 0)[:-1] for t in texts]
        return np.concatenate([np.empty(0, np.uint16), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


class Capacities:
    """Segment tree over free capacities 0..length: which of them some row has."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        i = free + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, row) of a row with the least free capacity >= need, removed from the tree."""
        i, count = need + self.leaves, self.count
        while not count[i]:                       # climb until a subtree to the right has a row
            while i & 1:
                i >>= 1
            if not i:
                return None
            i += 1
            if i & (i - 1) == 0:
                return None
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        free = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return free, self.rows[free].pop()


def best_fit_decreasing(sizes: np.ndarray, length: int = LENGTH) -> list[list[int]]:
    """Rows of piece numbers, each row's sizes summing to at most ``length`` (every size is at most that)."""
    rows: list[list[int]] = []
    tree = Capacities(length)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        got = tree.take(size)
        if got is None:
            free, row = length, len(rows)
            rows.append([])
        else:
            free, row = got
        rows[row].append(i)
        if free > size:
            tree.add(free - size, row)
    return rows


def _emit(pieces: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    rows = best_fit_decreasing(np.array([len(p[0]) for p in pieces]), length)
    ramp = np.arange(length, dtype="<u2")
    for lo in range(0, len(rows), 256):
        out: list[list] = [[], [], [], [], []]
        for row in rows[lo:lo + 256]:
            ids, pos, at = np.full(length, END_ID, "<u2"), np.zeros(length, "<u2"), [0]
            for i in row:
                part = pieces[i][0]
                a, b = at[-1], at[-1] + len(part)
                ids[a:b], pos[a:b] = part, ramp[:len(part)]
                at.append(b)
            for column, value in zip(out, (ids.tobytes(), pos.tobytes(), at, [pieces[i][1] for i in row],
                                           [pieces[i][2] for i in row]), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.list_(pa.int32())),
             pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], pa.list_(pa.int32()))],
            ["ids", "positions", "cu_seqlens", "doc_ids", "parts"])


def pack(docs: DataFrame, path: str = VOCABULARY_PATH, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """Packed rows of ``docs`` (doc_id, text)."""
    with open(path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, total = Tokenizer(ranks.value), [], 0
        for b in batches:
            keys = b.column("doc_id").to_pylist()
            for lo, hi, _, _ in slices(b.column("text"), TEXT_BYTES):
                for k, t in enumerate(b.column("text").slice(lo, hi - lo).fill_null("").to_pylist()):
                    whole = coder.ended(t, END_ID)
                    for part, a in enumerate(range(0, len(whole), length)):
                        held.append((whole[a:a + length], keys[lo + k], part))
                    total += len(whole)
                    if total >= window:
                        yield from _emit(held, length)
                        held, total = [], 0
        if held:
            yield from _emit(held, length)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def write_matrices(packed: DataFrame, out: str) -> DataFrame:
    """Write packed rows to ``out`` and read them back."""
    packed.write.option("compression", "zstd").parquet(out)
    return packed.sparkSession.read.parquet(out)
