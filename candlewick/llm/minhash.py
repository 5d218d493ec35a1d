"""Near-duplicate detection with DartMinHash signatures.

A document is the weighted set of its five-word shingles. Hashed darts are thrown at the regions an element
covers: the plane of (weight, rank) is cut into cells of area one, a hash of (element, cell) gives the
Poisson(1) number of darts in the cell and their places, and a dart counts if it lies below the element's
weight. Darts are dealt to ``BANDS * ROWS`` coordinates and the earliest of each coordinate is the
signature, so two sets agree in a coordinate with probability equal to their (weighted) Jaccard similarity.
Only darts of rank below t / (total weight), t = k ln k + 2k, are thrown; a document with a coordinate still
empty throws again with twice the rank.

Documents with equal shingle sets are folded first (one representative each). Representatives that share a
band are candidates: each round every band bucket picks a few centres (one at first, then members outside the
bucket's largest component), and pairs (centre, member) of different components are checked exactly (Jaccard >= 0.8
on the hashed shingles); links join components; used centres leave their bucket, having met every member of another
component, and buckets whose remaining members are in one component are done. Where a
bucket holds more than ``BUCKET_ROWS`` (many documents sharing a passage), its members are regrouped, after
one round, by the rarest shingles of their sets: sets of similarity t share one of their n - ceil(t n) + 1
rarest, under any one order of all shingles, so no link is lost and a common passage brings no one together.
A pair meets its exact check only if its parity maps allow the similarity: every shingle of a set flips one of ``PARITY`` bits, so
two sets whose maps differ in x bits differ in x shingles at least, and similarity t leaves at most (n + n') (1 - t) / (1 + t)
of those. The test stands in the bucket join and loses no link; all but pairs close below the threshold (and pairs of sets of
some thousand shingles, whose maps are full) end there. Buckets hold (bucket, node, root) only; sizes and maps are fetched for
the join. Sets are made of the members of open buckets only: a bitmap of hashed keys, of bounded size, keeps most other
texts out of the shuffle that finds them. The rounds end when no bucket is left, so every candidate pair is checked or already connected, while a group
of m near copies costs O(m) pairs and never m*m.

Defined results: null text counts as empty; texts without words form one class; texts under five words are
alike only if their words are equal. Rows sharing a doc_id and a text are one document and one class. A row without
doc_id gets a negative key from its text's hash; different texts that share a doc_id are different documents, each
with a negative key from doc_id and text. The class id is the smallest key in the class (a doc_id, where no row
of the class has a negative key).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.components import stars
from candlewick.llm.text import U, mix64, shingle_hashes, slices, unique_per_row
from candlewick.session import arrow_batches, write_and_read

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 28, 5          # a pair of similarity 0.8 misses every band with probability 1.5e-5
CENTRES = 1                  # centres a bucket in the first round; eight times as many every round, up to 512
BUCKET_ROWS = 24             # larger buckets are regrouped by rare shingles
PARITY = 1024                # bits of a set's parity map
MAPS = [f"p{i}" for i in range(PARITY // 64)]
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20      # of the Arrow batches that hold texts or sets
MARK_WORDS = 1 << 19         # most 64-bit words of a bitmap of keys
ORDER_BITS = 18              # shingle frequencies are counted in 2**18 hashed counters
_CDF = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])
_TO_UNIT = 2.0 ** -32


def signatures(values: np.ndarray, off: np.ndarray, weights: np.ndarray | None = None, k: int = BANDS * ROWS) -> np.ndarray:
    """(rows, k) DartMinHash signatures of weighted sets (distinct element hashes per row; weight 1 if none
    are given). Rows without elements get zeros."""
    n_rows = len(off) - 1
    out = np.zeros((n_rows, k), U)
    size = np.diff(off)
    total = size.astype(float) if weights is None else np.bincount(np.repeat(np.arange(n_rows), size), weights, n_rows)
    todo = np.flatnonzero(total > 0)
    reach = (k * math.log(k) + 2 * k) / np.maximum(total, 1e-300)
    while len(todo):
        left = _throw(values, off, weights, todo, reach, k, out)
        reach[left] *= 2
        todo = left
    return out


def _throw(values, off, weights, rows, reach, k, out) -> np.ndarray:
    """Throw darts for ``rows`` up to rank ``reach``; fills ``out``; returns rows with an empty coordinate."""
    n = off[rows + 1] - off[rows]
    own = np.repeat(np.arange(len(rows)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(off[rows], n)
    best = np.full(len(rows) * k, np.inf)
    sig = np.zeros(len(rows) * k, U)
    top = 1.0 if weights is None else float(weights[at].max())
    found = []
    level, low = 0, 0.0
    with np.errstate(over="ignore"):
        while low < top:
            high = 1.0 if level == 0 else low * 2
            width = high - low
            pick = slice(None) if weights is None else np.flatnonzero(weights[at] > low)
            doc, element = own[pick], values[at[pick]]
            heavy = None if weights is None else weights[at[pick]]
            cells = np.ceil(reach[rows][doc] * width).astype(np.int64)
            who = np.repeat(np.arange(len(doc)), cells)
            cell = np.arange(len(who)) - np.repeat(np.cumsum(cells) - cells, cells)
            h = mix64(element[who] + (cell.astype(U) * U(0x9FB21C651E98DF25) ^ U((level * 0xC2B2AE3D27D4EB4F + 1) & (2 ** 64 - 1))))
            darts = np.searchsorted(_CDF, (h >> U(32)).astype(float) * _TO_UNIT, "right")
            src = np.repeat(np.arange(len(h)), darts)
            nth = np.arange(len(src)) - np.repeat(np.cumsum(darts) - darts, darts)
            dart = mix64(h[src] + (nth.astype(U) + U(1)) * U(0x9E3779B97F4A7C15))
            rank = (cell[src] + (dart >> U(32)).astype(float) * _TO_UNIT) / width
            hit = rank < reach[rows][doc[who[src]]]
            if heavy is not None:
                place = low + width * (mix64(dart ^ U(0x5851F42D4C957F2D)) >> U(32)).astype(float) * _TO_UNIT
                hit &= place < heavy[who[src]]
            rank, dart, doc_of = rank[hit], dart[hit], doc[who[src[hit]]]
            key = doc_of * k + ((dart & U(0xFFFFFFFF)) * U(k) >> U(32)).astype(np.int64)
            np.minimum.at(best, key, rank)
            found.append((key, rank, dart))
            level, low = level + 1, high
        for key, rank, dart in found:
            first = rank == best[key]
            np.maximum.at(sig, key[first], mix64(dart[first] ^ U(0xA0761D6478BD642F)))
    out[rows] = sig.reshape(len(rows), k)
    return rows[np.isinf(best.reshape(len(rows), k)).any(1)]


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(rows, bands) 64-bit keys of the signature's bands."""
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=U) * U(0x9E3779B97F4A7C15), (len(sig), bands)).copy()
        for i in range(rows):
            key = mix64(key * U(0xD6E8FEB86659FD93) + sig[:, i:bands * rows:rows])
    return key.view(np.int64)


def parity_maps(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, PARITY / 64) words: bit j of a row is the parity of its (distinct) hashes that fall on j."""
    rows = len(off) - 1
    slot = np.repeat(np.arange(rows), np.diff(off)) * PARITY + (mix64(values) & U(PARITY - 1)).astype(np.int64)
    odd = (np.bincount(slot, minlength=rows * PARITY) & 1).astype(np.uint8)
    return np.packbits(odd).view(">u8").astype(np.uint64).view(np.int64).reshape(rows, PARITY // 64)


def _digests(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit order-free digests of each row's distinct hashes."""
    with np.errstate(over="ignore"):
        out = []
        for salt in (0x2545F4914F6CDD1D, 0x8CB92BA72F3D8DD7):
            run = np.concatenate([np.zeros(1, U), np.cumsum(mix64(values ^ U(salt)), dtype=U)])
            out.append((run[off[1:]] - run[off[:-1]]).view(np.int64))
    return out[0], out[1]


def doc_key(doc_id: Column, text: Column) -> Column:
    """doc_id, or a negative key of the text where it is null."""
    made = -F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(1 << 61)) - F.lit(1 << 62)
    return F.coalesce(doc_id.cast("bigint"), made)


def document_keys(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``_key``, and one (key, text) row of each key. Rows share a key if they have the same doc_id and the
    same text; texts that share a doc_id get a negative key of doc_id and text each."""
    body = F.coalesce("text", F.lit(""))
    keyed = docs.withColumn("_key", doc_key(F.col("doc_id"), F.col("text")))
    mark = F.xxhash64(body)
    again = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("rows"), (F.min(mark) != F.max(mark)).alias("_differ"))
    again = write_and_read(again.where("rows > 1").select("_key", "_differ"), "dart-again")
    if again.isEmpty():
        return keyed, keyed.select(F.col("_key").alias("key"), body.alias("text"))
    own = -F.pmod(F.xxhash64("_key", body), F.lit(1 << 61)) - F.lit(3 << 61)
    joined = keyed.join(again, "_key", "left").withColumn("_key", F.when(F.col("_differ"), own).otherwise(F.col("_key")))
    text = joined.select(F.col("_key").alias("key"), body.alias("text"), "_differ")
    once = text.where("_differ is null").unionByName(text.where("_differ is not null").dropDuplicates(["key"]))
    return joined.drop("_differ"), once.drop("_differ")


def _sketch(weighted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in slices(b.column("text")):
                v, voff, times = unique_per_row(*shingle_hashes(data, off, WIDTH))
                sig = signatures(v, voff, times.astype(float) if weighted else None)
                keys = band_keys(sig)
                some = np.diff(voff) > 0
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)),
                                                 pa.array(keys[some].ravel()))
                one, two = _digests(v, voff)
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").slice(lo, hi - lo), pa.array(one), pa.array(two), pa.array(np.diff(voff).astype(np.int32)), bands],
                    ["key", "one", "two", "n", "bands"])
    return run


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, off in slices(b.column("text")):
            v, voff, _ = unique_per_row(*shingle_hashes(data, off, WIDTH))
            raw = v.astype("<u8").tobytes()
            sets = [raw[8 * x:8 * y] for x, y in zip(voff[:-1], voff[1:], strict=True)]
            maps = parity_maps(v, voff)
            yield pa.RecordBatch.from_arrays(
                [b.column("key").slice(lo, hi - lo), pa.array(np.diff(voff).astype(np.int32)), pa.array(sets, pa.binary()),
                 *(pa.array(maps[:, i]) for i in range(len(MAPS)))], ["node", "n", "shingles", *MAPS])


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sorted sets of 64-bit hashes (binary columns)."""
    @F.arrow_udf("double")
    def udf(x: pa.Array, y: pa.Array) -> pa.Array:
        out = np.empty(len(x))
        for i, (p, q) in enumerate(zip(x, y, strict=True)):
            p, q = np.frombuffer(p.as_buffer(), "<u8"), np.frombuffer(q.as_buffer(), "<u8")
            joint = np.concatenate([p, q])
            joint.sort(kind="stable")
            both = int((joint[1:] == joint[:-1]).sum())
            out[i] = both / max(1, len(joint) - both)
        return pa.array(out)
    return udf(a, b)


def _frequencies(sets: DataFrame) -> np.ndarray:
    """Hashed shingle counts over all ``sets`` (2**ORDER_BITS numbers): the order in which shingles are rare."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for b in batches:
            raw = b"".join(b.column("shingles").to_pylist())
            total += np.bincount((np.frombuffer(raw, "<u8") >> U(64 - ORDER_BITS)).astype(np.int64), minlength=1 << ORDER_BITS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["slot", "n"])
    got = sets.mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << ORDER_BITS, np.int64)
    out[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return out


def rare_prefix(values: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """The n - ceil(threshold n) + 1 rarest of a set's shingles (ties by hash): two sets of at least that
    similarity share one of them."""
    keep = len(values) - math.ceil(threshold * len(values) - 1e-9) + 1
    order = np.lexsort((values, counts[(values >> U(64 - ORDER_BITS)).astype(np.int64)]))
    return values[order[:keep]]


def _prefixes(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [rare_prefix(np.frombuffer(v, "<u8"), shared.value, threshold) for v in b.column("shingles").to_pylist()]
            size = np.array([len(p) for p in parts])
            flat = np.concatenate(parts).astype(U).view(np.int64) if parts else np.empty(0, np.int64)
            names = ["node", "root"]
            yield pa.RecordBatch.from_arrays([pa.array(flat), *(pa.array(np.repeat(b.column(c).to_numpy(), size)) for c in names)],
                                             ["bucket", *names])
    return run


def _still_open(rows: DataFrame) -> DataFrame:
    """(bucket, rows) of the buckets whose members are of several components; of buckets with the same members
    (compared by two 64-bit digests), one. ``rows`` must hold a node once a bucket: repeats cancel out of the digests."""
    digest = [F.bit_xor(F.xxhash64("node", F.lit(salt))).alias(f"d{salt}") for salt in (1, 2)]
    every = rows.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("rows"), *digest)
    return every.where("x <> y").groupBy("rows", "x", "y", "d1", "d2").agg(F.min("bucket").alias("bucket")).select("bucket", "rows")


def classes(docs: DataFrame, threshold: float = THRESHOLD, weighted: bool = False) -> DataFrame:
    """(doc_id, key, class_id): the near-duplicate class of every row of ``docs`` (doc_id, text).

    ``weighted`` throws darts by shingle multiplicity; links are checked on the distinct shingles either way.
    """
    return _classes(*document_keys(docs.select("doc_id", "text")), threshold, weighted)


def _classes(keyed: DataFrame, text: DataFrame, threshold: float = THRESHOLD, weighted: bool = False) -> DataFrame:
    """``classes`` of what ``document_keys`` gives."""
    with arrow_batches(keyed.sparkSession, BATCH_ROWS, BATCH_BYTES):
        return _linked(keyed, text, threshold, weighted)


def marked(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is in ``keys``, and few others: keys are hashed to the bits of at most MARK_WORDS words,
    which reach every task, so a join that follows shuffles little else. Wide rows stay where they are."""
    slot = F.pmod(F.xxhash64("key"), F.lit(64 * MARK_WORDS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))
    words = keys.groupBy(F.shiftright(slot, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return rows.join(F.broadcast(words), (F.shiftright(slot, 6) == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0), "left_semi")


def _linked(keyed: DataFrame, text: DataFrame, threshold: float, weighted: bool) -> DataFrame:
    sk = write_and_read(text.mapInArrow(_sketch(weighted), "key bigint, one bigint, two bigint, n int, bands array<bigint>"), "dart-sketch")
    groups = write_and_read(sk.groupBy("one", "two", "n").agg(F.min("key").alias("node")), "dart-groups")
    reps = sk.join(groups, (F.col("key") == F.col("node")) & (sk.one == groups.one) & (sk.two == groups.two), "left_semi")
    banded = reps.select(F.col("key").alias("node"), F.explode("bands").alias("bucket"), F.col("key").alias("root"))
    active = write_and_read(banded.join(_still_open(banded), "bucket"), "dart-buckets")
    met = write_and_read(active.select(F.col("node").alias("key")).distinct(), "dart-met")
    sets = write_and_read(marked(text, met).join(met, "key", "left_semi").mapInArrow(
        _shingles, "node bigint, n int, shingles binary, " + ", ".join(f"{c} bigint" for c in MAPS)), "dart-sets")
    sizes, bodies = sets.drop("shingles"), sets.select("node", "shingles")
    theirs = sizes.select(*(F.col(c).alias(f"c_{c}") for c in sizes.columns))
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"c_{c}"))) for c in MAPS), F.lit(0))
    alike = differ <= (F.col("n") + F.col("c_n")) * F.lit((1 - threshold) / (1 + threshold)) + F.lit(1e-6)
    tree, centres, turn = None, CENTRES, 0
    while not active.isEmpty():
        spot = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "root")
        if turn == 0:      # one centre a bucket: most copies join through it
            able, seat = active, F.lit(0)
        else:              # centres from all components of a bucket but its largest, so a group of copies waits for the few others
            share = active.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("m"))
            most = share.groupBy("bucket").agg(F.max(F.struct("m", "root")).alias("most"))
            able = active.join(most, "bucket").where(F.col("root") != F.col("most.root"))
            seat = F.when(F.col("rows") - F.col("most.m") <= centres, F.col("node")).otherwise(F.pmod(F.xxhash64("node", F.lit(~turn)), F.lit(centres)))
        chosen = (able.groupBy("bucket", seat.alias("seat")).agg(F.min(spot).alias("c"))
                  .select("bucket", F.col("c.node").alias("c_node"), F.col("c.root").alias("c_root")))
        chosen = write_and_read(chosen, "dart-centres")
        pairs = (active.select("bucket", "node", "root").join(sizes, "node").join(chosen.join(theirs, "c_node"), "bucket")
                 .where((F.col("node") != F.col("c_node")) & (F.col("root") != F.col("c_root"))
                        & (F.least("n", "c_n") >= F.lit(threshold) * F.greatest("n", "c_n")) & alike)
                 .select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct())
        found = (pairs.join(bodies.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
                 .join(bodies.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
                 .where(jaccard(F.col("sa"), F.col("sb")) >= threshold).select("a", "b"))
        found = write_and_read(found, "dart-links")
        if not found.isEmpty():
            links = found if tree is None else found.unionByName(tree.select(F.col("node").alias("a"), F.col("root").alias("b")))
            tree = stars(links)
        rest = active.drop("rows").join(chosen.select("bucket", F.col("c_node").alias("node")), ["bucket", "node"], "left_anti")
        if turn == 0:      # centres of large buckets go on: their bucket is regrouped, not finished
            rest = rest.unionByName(active.where(F.col("rows") > BUCKET_ROWS).drop("rows")).distinct()
        if tree is not None:
            rest = rest.drop("root").join(tree, "node", "left").withColumn("root", F.coalesce("root", "node"))
        rest = write_and_read(rest.select("bucket", "node", "root"), "dart-rest")
        active = write_and_read(rest.join(_still_open(rest), "bucket"), "dart-buckets")
        if turn == 0:
            large = active.where(F.col("rows") > BUCKET_ROWS).select("node", "root").distinct()
            shared = keyed.sparkSession.sparkContext.broadcast(_frequencies(sets))
            rare = write_and_read(large.join(bodies, "node").mapInArrow(
                _prefixes(shared, threshold), "bucket bigint, node bigint, root bigint"), "dart-rare")
            rare = rare.join(_still_open(rare), "bucket")
            active = write_and_read(active.where(F.col("rows") <= BUCKET_ROWS).unionByName(rare.select(*active.columns)), "dart-buckets")
        centres, turn = min(8 * centres, 512), turn + 1
    named = groups if tree is None else groups.join(tree, "node", "left").withColumn("node", F.coalesce("root", "node")).drop("root")
    rows = sk.select("key", "one", "two", "n").join(named, ["one", "two", "n"]).select("key", F.col("node").alias("class_id"))
    return keyed.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("_key").alias("key")).join(rows, "key").select("doc_id", "key", "class_id")


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: of the rows whose key is the class id, the smallest by all columns in their order
    (by their JSON, if a column holds maps, which have no order). Columns of any name pass through."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed, text = document_keys(docs.select("doc_id", "text", row.alias("_row")))
    kept = _classes(keyed, text, **options).where("key = class_id").select(F.col("key").alias("_key")).distinct()
    order = F.to_json("_row") if "map<" in keyed.schema["_row"].dataType.simpleString() else F.col("_row")
    return keyed.join(kept, "_key", "left_semi").groupBy("_key").agg(F.min_by("_row", order).alias("_row")).select("_row.*")
