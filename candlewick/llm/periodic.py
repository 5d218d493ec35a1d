"""Periodic runs of words, found online by a sparse diagonal DP.

Words are read from left to right. Lag q names the diagonal of pairs (i, i - q); an active diagonal carries the
length of its present streak of equal words and loses it at the first unequal one. A streak of m words makes a
stretch of m + q words of period q, and a diagonal whose stretch is long enough (``MIN_WORDS`` words and
``MIN_PERIODS`` periods) emits its run the moment that it breaks off. Diagonals become active through the earlier
occurrences of the word just read. Two facts keep the DP sparse without losing a run:

* A streak of the least sufficient length M covers some aligned block of S words, S the largest power of two with
  2S - 1 <= M. So lag q is opened only where a block of its size S ends and equals the block q words earlier; the
  streak is then followed back, at most S words, to where it began. Short lags are tried often, long ones rarely:
  a text of n words costs O(n log n) looks, however often its words occur.
* If an active lag p divides q and p's stretch reaches back to the q-th last word, then both stretches are the same and
  end together (for 2 periods or more, by Fine and Wilf), and p is the smaller period. q stays closed.

So a run's period is its smallest one, and no word beside it extends it.

A word is a maximal run of bytes other than space, tab, LF, VT, FF and CR. ``collapsed`` is the text without the words
that a run holds after its first period, the others joined by one space.

Defined results: a null, empty or blank text has no runs, no best run and an empty collapsed text; ties of the best
run go to the smaller start, then the smaller period; repeated rows get equal results; extra columns pass through, but
a column named like ``out`` (or ``_text``) is an error.
"""

from __future__ import annotations

from array import array
from collections.abc import Sequence
from itertools import compress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import slices

MIN_WORDS = 6
MIN_PERIODS = 4
TEXT_BYTES = 4 << 20
RUN = "struct<start: bigint, length: bigint, period: bigint>"
RESULT = ("struct<n_words: bigint, runs: array<" + RUN + ">, best: struct<start: bigint, length: bigint, period: bigint, "
          "exponent_milli: bigint>, collapsed: string>")

Run = tuple[int, int, int]          # start, length, period


def block_size(lag: int, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> int:
    """Largest power of two S such that every streak that suffices for ``lag`` covers an aligned block of S words."""
    least = max(min_words - lag, (min_periods - 1) * lag)
    return 1 << (((least + 1) // 2).bit_length() - 1)


def find_runs(words: Sequence, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[Run]:
    """All runs (start, length, smallest period), by start, then period. ``min_periods`` is 2 or more."""
    if min_periods < 2:
        raise ValueError("runs have two periods at least")
    slot: dict = {}
    ids = [slot.setdefault(w, len(slot)) for w in words]
    n = len(ids)
    if len(slot) == n:
        return []
    flat = memoryview(array("I", ids).tobytes())
    earlier, last = [-1] * n, [-1] * len(slot)
    deepest = n // min_periods
    active: dict[int, int] = {}                  # lag -> first word of its stretch
    runs: list[Run] = []

    def close(lag: int, end: int) -> None:
        start = active.pop(lag)
        if end - start >= max(min_words, min_periods * lag):
            runs.append((start, end - start, lag))

    for i, w in enumerate(ids):
        if active:
            for lag in [q for q in active if ids[i - q] != w]:
                close(lag, i)
        j = earlier[i] = last[w]
        last[w] = i
        end = i + 1
        if j < 0:
            continue
        low = end & -end                         # the largest aligned block that ends here
        reach = min((4 * low - 2) // (min_periods - 1), deepest)
        while j >= 0 and i - j <= reach:
            lag = i - j
            j = earlier[j]
            if lag in active:
                continue
            size = block_size(lag, min_words, min_periods)
            if size > low or end - size < lag:
                continue
            if any(lag % p == 0 and end - lag >= start for p, start in active.items()):
                continue
            if flat[4 * (end - size):4 * end] != flat[4 * (end - size - lag):4 * (end - lag)]:
                continue
            at = end - size
            while at > lag and ids[at - 1] == ids[at - 1 - lag]:
                at -= 1
            active[lag] = at - lag
    for lag in list(active):
        close(lag, n)
    smallest: dict[tuple[int, int], int] = {}    # a stretch may also have been followed by a multiple opened earlier
    for start, length, lag in runs:
        smallest[start, length] = min(lag, smallest.get((start, length), lag))
    return sorted(((s, n, q) for (s, n), q in smallest.items()), key=lambda r: (r[0], r[2]))


def best_run(runs: list[Run]) -> Run | None:
    """The run of the greatest exact length / period (ties: smaller start, then period)."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapse(words: Sequence[bytes], runs: list[Run]) -> bytes:
    """Words outside the repetitions, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        keep[start + period:start + length] = bytes(length - period)
    return b" ".join(compress(words, keep))


def with_runs(df: DataFrame, text: str = "text", out: str = "repeats", min_words: int = MIN_WORDS,
              min_periods: int = MIN_PERIODS) -> DataFrame:
    """``df`` with a struct: n_words, runs, best (null without runs) and the collapsed text."""
    if out in df.columns:
        raise ValueError(f"the column {out} exists already")

    @F.arrow_udf(RESULT)
    def udf(arr: pa.Array) -> pa.Array:
        count, starts, at, best, short = [], [], [0], [], []
        for _, _, data, off in slices(arr, TEXT_BYTES):
            raw = data.tobytes()
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                words = raw[a:b].split()
                runs = find_runs(words, min_words, min_periods)
                top = best_run(runs)
                count.append(len(words))
                starts += runs
                at.append(len(starts))
                best.append(top and dict(zip(("start", "length", "period"), top), exponent_milli=1000 * top[1] // top[2]))
                short.append(collapse(words, runs))
        big = pa.int64()
        fields = [pa.field(f, big) for f in ("start", "length", "period")]
        run = pa.StructArray.from_arrays([pa.array([r[k] for r in starts], big) for k in range(3)], fields=fields)
        return pa.StructArray.from_arrays(
            [pa.array(count, big), pa.ListArray.from_arrays(pa.array(at, pa.int32()), run),
             pa.array(best, pa.struct([*fields, pa.field("exponent_milli", big)])),
             pa.array(short, pa.binary()).cast(pa.string())], ["n_words", "runs", "best", "collapsed"])
    return df.withColumn(out, udf(F.col(text)))
