"""Approximate nearest neighbours by low-dimensional stable projections and kd-trees.

Largest inner product is made a nearest-distance search by one more coordinate, sqrt(M^2 - |x|^2), M the
largest norm (queries have 0 there). A Gaussian (2-stable) projection to ``DIMS`` dimensions keeps distances
as d^2 times a chi-square of ``DIMS`` degrees. A kd-tree over the projected points, its upper levels fitted on a
bounded sample, deals every vector to a block; each block holds the lower levels. A query takes the leaves of
its home block, then of the other blocks, in order of projected distance, verifies the vectors by exact inner
product, and stops when the next leaf lies so far that a vector as near as its k-th would have shown up
before with probability ``SURE`` (chi-square test: leaf distance^2 > d_k^2 * quantile).

Blocks hold at most about ``BLOCK_ROWS`` rows (a hot region, such as copies of one vector, is dealt over
several by a hash), queries go in chunks of at most about ``CHUNK_ROWS``; a (chunk, block) pair that some query of
the chunk still needs is one row of an equi-join. Tables of blocks and chunks, never of vectors, reach the driver.

Defined results: vectors that are null, zero, hold null or non-finite components, have no vec_id, or differ
from the table's usual length take no part; a query's own vec_id is never a candidate; rows sharing a vec_id
count once, with their best score; equal scores go to the smaller vec_id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import write_and_read

K = 20
DIMS = 8                   # projected dimensions (even)
SURE = 0.97
SAMPLE_ROWS = 20_000       # rows the upper tree is fitted on, in expectation
BLOCK_ROWS = 1024
MOST_BLOCKS = 4096         # blocks of the upper tree
LEAF_ROWS = 128
CHUNK_ROWS = 1024
CHUNKS_HELD = 64           # chunks whose running best a task keeps


def chi_square_quantile(p: float, m: int) -> float:
    """x with P(chi-square of m degrees <= x) = p, for even m."""
    def cdf(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total
    low, high = 0.0, 10.0 * m + 100
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


@dataclass
class Index:
    """Projection, upper kd-tree (complete binary tree of split dimensions and values) and largest norm^2."""

    matrix: np.ndarray      # (d + 1, m)
    top: float              # M^2
    dims: np.ndarray        # split dimension of each inner node
    cuts: np.ndarray        # split value

    def project(self, v: np.ndarray, query: bool = False) -> np.ndarray:
        out = v @ self.matrix[:-1]
        if not query:
            rest = np.sqrt(np.maximum(self.top - np.einsum("ij,ij->i", v, v), 0.0))
            out = out + rest[:, None] * self.matrix[-1]
        return out

    def block(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while len(self.dims) and node.min(initial=len(self.dims)) < len(self.dims):
            right = points[np.arange(len(points)), self.dims[node]] > self.cuts[node]
            node = 2 * node + 1 + right
        return node - len(self.dims)


def fit_index(sample: np.ndarray, top: float, blocks: int, dims: int = DIMS, seed: int = 5) -> Index:
    """Upper tree with ``blocks`` leaves (a power of two) by median splits of the widest dimension."""
    rng = np.random.default_rng(seed)
    index = Index(rng.standard_normal((sample.shape[1] + 1, dims)), top, np.zeros(blocks - 1, np.int64), np.zeros(blocks - 1))
    parts = [index.project(sample)]
    for node in range(blocks - 1):
        p = parts[node]
        d = int(np.argmax(p.max(0) - p.min(0))) if len(p) else 0
        cut = float(np.median(p[:, d])) if len(p) else 0.0
        index.dims[node], index.cuts[node] = d, cut
        parts += [p[p[:, d] <= cut], p[p[:, d] > cut]]
    return index


def leaves(points: np.ndarray, size: int = LEAF_ROWS) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree over ``points``."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        p = points[rows]
        d = int(np.argmax(p.max(0) - p.min(0)))
        order = np.argsort(p[:, d], kind="stable")
        half = len(rows) // 2
        todo += [rows[order[:half]], rows[order[half:]]]
    return out


def _matrix(arr: pa.Array, d: int) -> np.ndarray:
    values = arr.flatten() if isinstance(arr, (pa.ListArray, pa.LargeListArray)) else arr
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def _best(q: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k best of each query: highest score, then smallest vec_id; a vec_id once."""
    order = np.lexsort((vec, -score, q))
    qs, vs = q[order], vec[order]
    by_id = np.lexsort((order, -score[order], vs, qs))          # first copy of each (query, vec_id)
    first = np.ones(len(order), bool)
    a = by_id
    first[a[1:]] = (qs[a[1:]] != qs[a[:-1]]) | (vs[a[1:]] != vs[a[:-1]])
    order, qs = order[first], qs[first]
    start = np.searchsorted(qs, qs, "left")
    return order[np.arange(len(order)) - start < k]


def search_block(query_ids, queries, bounds, vec_ids, vectors, index: Index, k: int = K, sure: float = SURE):
    """(query row, vec_id, score) of the best of one block for each query, given each query's k-th best score so
    far (``bounds``; -inf if it has fewer)."""
    points, at = index.project(vectors), index.project(queries, query=True)
    tree = leaves(points)
    low = np.stack([points[r].min(0) for r in tree])
    high = np.stack([points[r].max(0) for r in tree])
    gap = np.zeros((len(queries), len(tree)))
    for j in range(points.shape[1]):
        side = np.maximum(low[:, j][None, :] - at[:, j][:, None], at[:, j][:, None] - high[:, j][None, :])
        gap += np.maximum(side, 0.0) ** 2
    order = np.argsort(gap, axis=1, kind="stable")
    limit = chi_square_quantile(sure, points.shape[1])
    norm = np.einsum("ij,ij->i", queries, queries) + index.top
    kth = np.asarray(bounds, float).copy()
    found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    going = np.arange(len(queries))
    for step in range(len(tree)):
        far = gap[going, order[going, step]]
        reach = np.maximum(norm[going] - 2 * kth[going], 0.0) * limit       # d_k^2 times the quantile
        going = going[~(far > reach)]
        if not len(going):
            break
        new = []
        leaf_of = order[going, step]
        for leaf in np.unique(leaf_of):
            who, rows = going[leaf_of == leaf], tree[leaf]
            rough = queries[who] @ vectors[rows].T
            a, b = np.nonzero(rough >= (kth[who] - 1e-9 * (1 + np.abs(np.where(np.isfinite(kth[who]), kth[who], 0))))[:, None])
            a, b = who[a], rows[b]
            other = query_ids[a] != vec_ids[b]
            a, b = a[other], b[other]
            new.append((a, vec_ids[b], np.einsum("ij,ij->i", queries[a], vectors[b])))
        found = tuple(np.concatenate([f, *(n[i] for n in new)]) for i, f in enumerate(found))
        keep = _best(found[0], found[2], found[1], k)
        found = tuple(f[keep] for f in found)
        count = np.bincount(found[0], minlength=len(queries))
        full = np.flatnonzero(count >= k)
        last = np.cumsum(count)[full] - 1
        kth[full] = np.maximum(kth[full], found[2][last])
    return found


def usable(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int, float, int]:
    """(rows (vec_id, v) that take part, their length, largest norm^2, number)."""
    v = F.col(vector).cast("array<double>")
    good = df.select(F.col(key).cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0))
    sizes = good.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("top")).collect()
    if not sizes:
        return good, 0, 0.0, 0
    d, n, top = max(sizes, key=lambda r: (r["n"], r["d"]))
    return good.where(F.size("v") == d), d, top, n


def nearest(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = K,
            sure: float = SURE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of every row for which ``queries`` (a condition on
    ``vec_id``) holds, by largest inner product among all other rows."""
    spark = df.sparkSession
    rows, d, top, total = usable(df, key, vector)
    out = "query_id bigint, vec_id bigint, score double"
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    blocks = 1 << max(0, min(MOST_BLOCKS, -(-total // (BLOCK_ROWS // 2))).bit_length() - 1)
    rate = int((1 << 30) * min(1.0, SAMPLE_ROWS / total))
    sample = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30)) < rate).orderBy("vec_id", "v").select("v").toArrow()
    index = fit_index(_matrix(sample.column(0).combine_chunks(), d) if sample.num_rows else np.zeros((0, d)), top, blocks)
    shared = spark.sparkContext.broadcast(index)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column("v"), d)
            ix = shared.value
            raw = v.astype("<f8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(ix.block(ix.project(v))), pa.array(ix.block(ix.project(v, query=True))),
                 pa.array([raw[i:i + 8 * d] for i in range(0, len(raw), 8 * d)], pa.binary())], ["vec_id", "block", "home", "v"])

    placed = write_and_read(rows.mapInArrow(locate, "vec_id bigint, block bigint, home bigint, v binary"), "ann-rows")
    asked = placed.where(queries)
    in_block = {r[0]: r[1] for r in placed.groupBy("block").count().collect()}        # at most MOST_BLOCKS rows
    in_home = {r[0]: r[1] for r in asked.groupBy("home").count().collect()}
    if not in_home:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    # parts of each block; runs of homes form chunks, a large home several
    parts, first_part = {}, {}
    n_parts = 0
    for b in sorted(in_block):
        parts[b], first_part[b] = -(-in_block[b] // BLOCK_ROWS), n_parts
        n_parts += parts[b]
    chunk_of, n_chunks, filled = {}, 0, 0
    for h in sorted(in_home):
        if filled and filled + in_home[h] > CHUNK_ROWS:
            n_chunks, filled = n_chunks + 1, 0
        own = -(-in_home[h] // CHUNK_ROWS)
        chunk_of[h] = (n_chunks, own)
        n_chunks, filled = (n_chunks + own, 0) if own > 1 else (n_chunks, filled + in_home[h])

    def lookup(column: str, table: dict[int, tuple[int, int]]) -> Column:
        """first + hash(vec_id) mod own, by block number."""
        first = np.zeros(blocks, np.int64)
        own = np.ones(blocks, np.int64)
        for b, (f, o) in table.items():
            first[b], own[b] = f, o
        sent = spark.sparkContext.broadcast((first, own))

        @F.arrow_udf("bigint")
        def udf(b: pa.Array, salt: pa.Array) -> pa.Array:
            f, o = sent.value
            i = b.to_numpy(zero_copy_only=False)
            return pa.array(f[i] + np.mod(salt.to_numpy(zero_copy_only=False), o[i]))
        return udf(F.col(column), F.xxhash64("vec_id", F.lit(13)))

    def packed(frame: DataFrame, by: str, extra: list[str]) -> DataFrame:
        """One row per group: vec_ids, vectors and home blocks as binary (a group is bounded by its salt)."""
        def pack(t: pa.Table) -> pa.Table:
            t = t.combine_chunks().sort_by("vec_id")
            cols = {by: [t.column(by)[0].as_py()], "n": [t.num_rows],
                    f"{by}_ids": [t.column("vec_id").to_numpy().astype("<i8").tobytes()],
                    f"{by}_v": [b"".join(t.column("v").to_pylist())]}
            for c in extra:
                cols[f"{by}_{c}"] = [t.column(c).to_numpy().astype("<i8").tobytes()]
            return pa.table(cols, schema=pa.schema([(by, pa.int64()), ("n", pa.int32())] + [(c, pa.binary()) for c in list(cols)[2:]]))
        schema = f"{by} bigint, n int, {by}_ids binary, {by}_v binary" + "".join(f", {by}_{c} binary" for c in extra)
        return frame.groupBy(by).applyInArrow(pack, schema)

    body = write_and_read(packed(placed.withColumn("part", lookup("block", {b: (first_part[b], parts[b]) for b in parts})).select("part", "vec_id", "v"),
                                 "part", []), "ann-blocks").drop("n")
    asks = write_and_read(packed(asked.withColumn("chunk", lookup("home", chunk_of)).select("chunk", "vec_id", "v", "home"),
                                 "chunk", ["home"]), "ann-queries").drop("n")
    block_of_part = np.concatenate([np.full(parts[b], b) for b in sorted(parts)])

    def look(first_round: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, dict] = {}       # chunks met by this task: their queries' best so far
            for b in batches:
                for r in b.to_pylist():
                    c = held.get(r["chunk"])
                    if c is None:
                        if len(held) >= CHUNKS_HELD:
                            yield from map(best_of, held.values())
                            held.clear()
                        ids = np.frombuffer(r["chunk_ids"], "<i8")
                        c = held[r["chunk"]] = {"ids": ids, "q": np.frombuffer(r["chunk_v"], "<f8").reshape(-1, d),
                                                "home": np.frombuffer(r["chunk_home"], "<i8"), "bounds": np.full(len(ids), -np.inf),
                                                "found": (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))}
                        if not first_round and r["seen_ids"] is not None:
                            c["bounds"][np.searchsorted(ids, np.array(r["seen_ids"], np.int64))] = np.array(r["seen_kth"])
                    at_home = c["home"] == block_of_part[r["part"]]
                    pick = np.flatnonzero(at_home if first_round else ~at_home)
                    if not len(pick):
                        continue
                    v = np.frombuffer(r["part_v"], "<f8").reshape(-1, d)
                    who, vec, score = search_block(c["ids"][pick], c["q"][pick], c["bounds"][pick], np.frombuffer(r["part_ids"], "<i8"), v,
                                                   shared.value, k, sure)
                    found = tuple(np.concatenate([x, y]) for x, y in zip(c["found"], (pick[who], vec, score), strict=True))
                    keep = _best(found[0], found[2], found[1], k)
                    c["found"] = found = tuple(x[keep] for x in found)
                    n = np.bincount(found[0], minlength=len(c["ids"]))
                    full = np.flatnonzero(n >= k)
                    c["bounds"][full] = np.maximum(c["bounds"][full], found[2][np.cumsum(n)[full] - 1])
            yield from map(best_of, held.values())
        return run

    def best_of(c: dict) -> pa.RecordBatch:
        who, vec, score = c["found"]
        return pa.RecordBatch.from_arrays([pa.array(c["ids"][who]), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])

    homes = spark.createDataFrame([(h, c + i) for h, (c, own) in chunk_of.items() if h in parts for i in range(own)], "block bigint, chunk bigint")
    owned = spark.createDataFrame([(b, first_part[b] + j) for b in parts for j in range(parts[b])], "block bigint, part bigint")
    start = homes.join(F.broadcast(owned), "block").select("chunk", "part")
    pairs = start.join(asks, "chunk").join(body, "part")
    one = write_and_read(pairs.mapInArrow(look(True), out), "ann-home")
    by_query = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    unique = one.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    kth = unique.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    keyed = asked.select(F.col("vec_id").alias("query_id"), lookup("home", chunk_of).alias("chunk")).join(kth, "query_id")
    seen = keyed.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("query_id", "kth"))).alias("s")).select(
        "chunk", F.col("s.query_id").alias("seen_ids"), F.col("s.kth").alias("seen_kth"))          # at most a chunk's queries
    chunks = asks.join(seen, "chunk", "left")
    every = chunks.select("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_parts - 1).cast("bigint"))).alias("part"))
    two = write_and_read(every.join(chunks, "chunk").join(body, "part").mapInArrow(look(False), out), "ann-rest")
    both = one.unionByName(two).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (both.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
