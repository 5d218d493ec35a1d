"""Mixing, packing, pieces, neighbours and the pipeline against brute force and round trips."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SF_SMALL
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb

import corpus_pipeline
from candlewick.llm import language, minhash, mixing, neighbours, oracle, packing, pieces, queries, toxicity
from candlewick.sources.tables import table

SF = SF_SMALL.replace("sf0.001", "sf0.01")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# --- mixing -----------------------------------------------------------------------------------------------------

def test_mixing_matches_its_sql(spark):
    con = duckdb.connect()
    for d in (SF_SMALL, SF):
        con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet')")
        got = queries.op10_mixing(spark, d)
        want = con.execute(oracle.OP10)
        assert sorted(got.columns) == sorted(c[0] for c in want.description)
        cols = [c[0] for c in want.description]
        assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want.fetchall())


def _targets(sizes):
    """Plain rounds: give by weight, stop at the cap, reshare the excess."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while open_ and left > 1e-9:
        unit = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * unit > 2 * sizes[s]}
        if not over:
            return out | {s: w[s] * unit for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mixing_targets_nulls_and_repeats(spark):
    r = random.Random(4)
    rows = [(i, " ".join("w" * r.randint(1, 3) for _ in range(r.randint(0, 30))), "en", r.choice(["b", "a", "é", None, "Z", "hot", "hot", "hot"]), 0)
            for i in range(600)] + [(601, None, "en", "a", 0), (None, "x y", None, None, 0), (5, "again and again", "en", "a", 0), (602, " ", "en", "void", 0)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.taken(df).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    by_id = {(x[0], x[1]): x for x in rows}
    src = df.select("doc_id", "source", mixing.word_count(F.col("text")).alias("n")).collect()
    for x in src:
        sizes[x.source] = sizes.get(x.source, 0) + x.n
    want = _targets(sizes)
    narrow, per = mixing.mix(df)
    for x in per.collect():
        target[x._mix_s] = x._mix_target
        assert x._mix_source_size == sizes[x._mix_s]
    assert {k: round(v, 6) for k, v in target.items()} == {k: round(v, 6) for k, v in want.items()}
    assert all(0 <= x.taken <= 2 * x.size for x in got) and by_id
    full = narrow.join(per, F.col("source").eqNullSafe(F.col("_mix_s")))
    copies = F.col("whole") + (F.col("h") < F.col("below")).cast("int")
    for x in full.groupBy("source").agg(F.sum(F.col("size") * copies).alias("t")).collect():
        taken[x.source] = x.t
    assert all(abs(taken[s] - target[s]) <= 30 for s in target)
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    assert mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(x.taken for x in got)
    assert mixing.taken(spark.createDataFrame([], DOCS)).count() == 0


def test_rows_without_an_id_are_taken_near_the_target(spark):
    rows = [(None, " ".join([f"w{i}"] * (1 + i % 9)), "en", "nulls", 0) for i in range(300)] + [(i, "x y z", "en", "b", 0) for i in range(900)]
    got = mixing.taken(spark.createDataFrame(rows, DOCS)).where("doc_id is null").collect()
    assert abs(sum(r.taken for r in got) - got[0].target) <= 9 and {r.taken // r.size for r in got} <= {0, 1, 2}


# --- packing ----------------------------------------------------------------------------------------------------

def test_best_fit_decreasing_matches_a_plain_search():
    r = random.Random(1)
    for length, n in ((1, 5), (10, 40), (64, 300)):
        sizes = np.array([r.randint(1, length) for _ in range(n)])
        got = packing.best_fit_decreasing(sizes, length)
        assert sorted(i for row in got for i in row) == list(range(n))
        free, loads = [], []
        for s in sorted(sizes.tolist(), reverse=True):
            fit = min((f for f in free if f >= s), default=None)
            if fit is None:
                fit = length
            else:
                free.remove(fit)
            free.append(fit - s)
        loads = sorted(length - f for f in free)
        assert sorted(int(sizes[row].sum()) for row in got) == loads and max(loads) <= length


def test_tokenizer_equals_the_library_on_odd_spacing():
    with open(packing.VOCABULARY_PATH, "rb") as f:
        t = packing.Tokenizer(f.read())
    texts = ["a  b", " a", "a \n b", "x  y", "a\tb c", "foo\n\nbar baz", "it's I'll", "a 1 2  3 ", "　a b", "", "é漢字 \U0001f642", "x" * 3000]
    ids, off = t.encode(texts)
    assert [ids[off[i]:off[i + 1]].tolist() for i in range(len(texts))] == [t.coder.encode_ordinary(x) for x in texts]


def test_packing_is_lossless(spark):
    r = random.Random(2)
    texts = ["", None, "word " * 2500] + [" ".join("abc"[:r.randint(1, 3)] * r.randint(1, 3) for _ in range(r.randint(1, 200))) for _ in range(80)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(7, texts[7], "x")], "doc_id bigint, text string, ids string").repartition(3)
    rows = packing.pack(df, length=256, window=4000).collect()
    got: dict = {}
    for row in rows:
        ids, pos, cu = np.frombuffer(row.ids, "<u2"), np.frombuffer(row.positions, "<u2"), row.cu_seqlens
        assert len(ids) == len(pos) == 256 and cu[0] == 0 and cu[-1] <= 256 and len(cu) == len(row.doc_ids) + 1
        for i, (d, p) in enumerate(zip(row.doc_ids, row.parts)):
            assert pos[cu[i]:cu[i + 1]].tolist() == list(range(cu[i + 1] - cu[i]))
            got.setdefault(d, []).append((p, ids[cu[i]:cu[i + 1]].tolist()))
    with open(packing.VOCABULARY_PATH, "rb") as f:
        coder = packing.Tokenizer(f.read()).coder
    for i, t in enumerate(texts):
        parts = sorted(got[i])
        assert [p for p, _ in parts] == sorted([*range(len({p for p, _ in parts}))] * (2 if i == 7 else 1))
        if i != 7:
            ids = [x for _, part in parts for x in part]
            assert ids[-1] == packing.END_ID and coder.decode(ids[:-1]) == (t or "")
            assert all(len(part) == 256 for _, part in parts[:-1])
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_packing_query_keeps_every_document(spark):
    got = queries.op8_packing(spark, SF)
    ids = {x for r in got.select("doc_ids").collect() for x in r.doc_ids}
    assert ids == {x.doc_id for x in table(spark, SF, "documents").select("doc_id").collect()}


# --- pieces -----------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def unigram():
    """The public pieces as a unigram model of the library; its float sums need scores of like size."""
    m = pb.ModelProto()
    with open(pieces.MODEL_PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        p.score = max(p.score, -40000.0)
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString()), [(p.piece, p.score, p.type) for p in m.pieces]


def test_viterbi_equals_the_library(unigram):
    sp, vocabulary = unigram
    coder = pieces.Encoder(pieces.Vocabulary(vocabulary))
    rows = duckdb.execute(f"SELECT text FROM read_parquet('{SF}/documents.parquet')").fetchall()
    texts = [s for (t,) in rows[:200] for s in t.split("\n")][:2000]
    texts += ["", " ", "  ", "a  b", " a", "a ", "漢字 x\ty", "\U0001f642\U0001f642", "x" * 500, "ab" * 300 + " é", "a\n\nb", "▁a"]
    texts = [t for t in texts if "▁" not in t]
    ids, off = coder.encode(texts)
    assert [ids[off[i]:off[i + 1]].tolist() for i in range(len(texts))] == [sp.encode(t) for t in texts]


def test_every_text_decodes_to_itself(spark):
    texts = ["", " ", "a  b ", "x▁y", "▁", "\x00\x07", "é漢\U0001f642", "word " * 5000, "y" * 4000, None, "\n\n a"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id bigint, text string, key string")
    got = df.withColumn("p", pieces.round_trip(F.col("text"), spark)).select("doc_id", "p.*").collect()
    lossy = {i for i, t in enumerate(texts) if t and "▁" in t}
    assert {x.doc_id for x in got if not x.lossless} <= lossy
    coded = pieces.encode(df)
    back = {x.doc_id: x.out for x in pieces.decode(coded, out="out").collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts) if i not in lossy)
    assert queries.op9_pieces(spark, SF).where("not lossless").count() == 0
    assert pieces.encode(spark.createDataFrame([], "text string")).count() == 0


def test_a_worker_holds_the_words_of_a_megabyte_at_a_time(monkeypatch):
    most = []
    real = pieces.WordCache.lookup
    monkeypatch.setattr(pieces.WordCache, "lookup", lambda self, words: most.append(sum(map(len, words))) or real(self, words))
    monkeypatch.setattr(pieces.F, "arrow_udf", lambda kind: lambda f: lambda c: f(c))      # the function that the tasks run

    class Frame:
        class sparkSession:
            class sparkContext:
                broadcast = staticmethod(lambda v: type("Shared", (), {"value": v}))

        def withColumn(self, name, ids):
            return ids
    texts = [f"word{i % 7} " * 500 for i in range(1200)] + [None, ""]
    monkeypatch.setattr(pieces.F, "col", lambda name: pa.array(texts))
    ids = pieces.encode(Frame())
    assert len(most) > 3 and max(most) < (1 << 20) + 20_000
    coder = pieces.Encoder(pieces.Vocabulary.load())
    whole, off = coder.encode([t or "" for t in texts])
    assert ids.flatten().to_numpy().tolist() == whole.tolist() and ids.offsets.to_pylist() == off.tolist()


def test_decode_skips_nulls_and_unknown_ids(spark):
    ids = pieces.encode(spark.createDataFrame([("two words",)], "text string")).first().ids
    rows = [(1, [ids[0], None, *ids[1:], None]), (2, None), (3, []), (4, [None]), (5, [-1, 10 ** 6, 1])]
    got = {r.i: r.text for r in pieces.decode(spark.createDataFrame(rows, "i int, ids array<int>")).collect()}
    assert got == {1: "two words", 2: "", 3: "", 4: "", 5: ""}


# --- neighbours -------------------------------------------------------------------------------------------------

def _nearest(rows, k=20):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v
          and np.isfinite(np.array(v, float)).all() and any(v)}
    ids = sorted(ok)
    m = np.stack([ok[i] for i in ids])
    out = {}
    for i in ids:
        if i % 20 == 0:
            s = np.einsum("ij,ij->i", m, np.broadcast_to(ok[i], m.shape))
            order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-s[j], ids[j]))[:k]
            out[i] = [(ids[j], s[j]) for j in order]
    return out


def test_chi_square_quantile():
    assert abs(neighbours.chi_square_quantile(0.95, 2) + 2 * np.log(0.05)) < 1e-9
    assert abs(neighbours.chi_square_quantile(0.95, 8) - 15.50731) < 1e-4


def test_neighbours_reach_recall_and_exact_scores(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 8)) * 2
    rows = [(i, (centres[i % 30] + rng.normal(size=8)).tolist()) for i in range(4000)]
    rows += [(4000 + i, rows[40][1]) for i in range(1500)]                        # one hot vector
    rows += [(9001, None), (9002, [0.0] * 8), (9003, [1.0, None] + [0.0] * 6), (9004, [float("nan")] + [1.0] * 7), (9005, [1.0]),
             (9006, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (60, rows[60][1])]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id bigint, embedding array<double>, score double")
    got: dict = {}
    for x in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    want = _nearest(rows)
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in [v for _, v, _ in found]
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        hits += len({v for _, v, _ in found} & {v for v, _ in want[q]})
        exact = dict(want[q])
        assert all(abs(s - exact[v]) < 1e-9 for _, v, s in found if v in exact)
    assert hits / (20 * len(want)) > 0.95
    few = df.where("vec_id in (0, 1, 2) or vec_id > 9000")
    assert neighbours.nearest(few, F.col("vec_id") % 20 == 0).count() == 2
    assert neighbours.nearest(df.where("vec_id > 9000"), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_of_one_hot_region_are_paired_off_the_driver(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 32)
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", 16)
    df = spark.createDataFrame([(i, [1.0, 2.0, 3.0, 4.0]) for i in range(600)], "vec_id bigint, embedding array<double>")
    listed, make = [], type(spark).createDataFrame

    def counted(self, data, *args, **kwargs):
        listed.append(len(data))
        return make(self, data, *args, **kwargs)
    monkeypatch.setattr(type(spark), "createDataFrame", counted)
    got = {}
    for x in neighbours.nearest(df, F.lit(True)).collect():
        got.setdefault(x.query_id, {})[x.rank] = x.vec_id
    assert got == {q: dict(enumerate([i for i in range(21) if i != q][:20], 1)) for q in range(600)}
    assert listed and max(listed) <= 600 // 16 + 600 // 32 + 2      # not chunks times parts


def test_neighbour_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], float)
    hits = n = 0
    for q, g in queries.op7_neighbours(spark, SF).toPandas().groupby("query_id"):
        s = m @ m[ids == q][0]
        s[ids == q] = -np.inf
        hits, n = hits + len(set(ids[np.lexsort((ids, -s))[:20]]) & set(g.vec_id)), n + 20
    assert n and hits / n > 0.95


# --- pipeline ---------------------------------------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    seen = docs
    for (name, stage), operator in zip(corpus_pipeline.STAGES, (toxicity, language, minhash, mixing, pieces), strict=True):
        before, seen = seen, stage(spark, seen, SF)
        assert operator.__name__.split(".")[-1] and name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert seen.columns == list(corpus_pipeline.COLUMNS)
        if name in ("toxicity", "language", "near-duplicates"):
            assert 0.5 * before.count() < seen.count() <= before.count()
        seen = spark.createDataFrame(seen.collect(), seen.schema)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.n_tokens) for r in whole.collect()) == sorted((r.doc_id, r.n_tokens) for r in seen.collect())
    bad = {r.doc_id for r in table(spark, SF, "labels").where("toxic = 1").collect()}
    kept = {r.doc_id for r in whole.collect()}
    assert len(bad & kept) < 0.5 * len(bad)


def test_pipeline_stages_handle_nulls_and_empty_tables(spark):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, "the and that is of", "en", None, 1),
                                 (3, "the and that is of", "en", None, 1), (4, "the and " * 30000, "en", "a", 9)], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, SF).collect()
        assert stage(spark, odd.limit(0), SF).count() == 0
