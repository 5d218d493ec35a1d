"""Text primitives, fingerprints and MinHash against plain Python."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlewick.llm import components, fingerprints, minhash, text

SCHEMA = "doc_id bigint, text string, n_chars int, key string"
TEXTS = ["", None, "one", "one two", "a b c d e", "A b C d E", "a b c d e f g h", " a\tb\nc  d e ", "é à É x y z", "x" * 5000, "word " * 300,
         "漢字 かな 混じり 文 です よ", "a b c d e"]


def plain_words(t):
    return [w for w in __import__("re").split("[ \t\n\v\f\r]+", t or "") if w]


def shingles(t, lower=True):
    w = plain_words((t or "").lower() if lower else t)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_words_and_shingles_match_plain_python():
    arr = pa.array(TEXTS, pa.string())
    data, off = text.utf8_buffers(arr)
    start, end, woff = text.word_bounds(data, off)
    for i, t in enumerate(TEXTS):
        got = [bytes(data[a:b]).decode() for a, b in zip(start[woff[i]:woff[i + 1]], end[woff[i]:woff[i + 1]])]
        assert got == plain_words(t)
    h, soff = text.shingle_hashes(data, off)
    rows = [set(h[soff[i]:soff[i + 1]].tolist()) for i in range(len(TEXTS))]
    for i, a in enumerate(TEXTS):
        assert len(rows[i]) == len(shingles(a))
        for j, b in enumerate(TEXTS):
            assert len(rows[i] & rows[j]) == len(shingles(a) & shingles(b))


def test_slices_cover_every_row_once_and_keep_long_texts_whole():
    arr = pa.array(["a" * 10, None, "b" * 1000, "", "c" * 3])
    seen = [(lo, hi) for lo, hi, _, _ in text.slices(arr, 50)]
    assert seen[0][0] == 0 and seen[-1][1] == 5 and all(a[1] == b[0] for a, b in zip(seen, seen[1:]))


def _edit_rows(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (k, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        h = len(t) // 2
        out[k] = (len(t), hashlib.sha256((t[:len(t) - h] + nxt[:h]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("n", [1, 2, 700])
def test_edit_likeness_matches_brute_force(spark, n):
    r = random.Random(n)
    rows = [(i * 3 + 1, r.choice(TEXTS[:4] + [" ".join(r.choice("abcdefgh") + str(r.randint(0, 30)) for _ in range(r.randint(1, 60)))])) for i in range(n)]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], SCHEMA)
    got = {x.doc_id: x for x in fingerprints.edit_likeness(df).collect()}
    want = _edit_rows(rows)
    assert len(got) == n and all((got[k].n_chars, got[k].edited_sha256) == want[k] for k in want)
    by_text = {}
    for k, t in rows:
        assert by_text.setdefault(t or "", got[k].fingerprint) == got[k].fingerprint
        assert 0 <= got[k].near_edited <= 1 and 0 <= got[k].near_next <= 1


def test_edit_likeness_of_an_empty_table_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert fingerprints.edit_likeness(df).count() == 0
    df = spark.createDataFrame([(1, "a b", 1, "k"), (1, "a b", 1, "k"), (None, "c", 1, "k"), (None, None, 1, "k")], SCHEMA)
    got = fingerprints.edit_likeness(df).collect()
    assert len(got) == 4 and sorted(x.n_chars for x in got) == [0, 1, 3, 3]


def test_fingerprint_estimates_likeness_and_merges(spark):
    r = random.Random(1)
    w = [str(r.random()) for _ in range(4000)]
    a, b = " ".join(w[:2000]), " ".join(w[500:4000])
    fa, fb, fab = fingerprints.sketch_rows(pa.array([a, b, " ".join(w)]))
    like, a_in_b, b_in_a = (x[0] for x in fingerprints.compare_rows([fa], [fb]))
    assert abs(like - 1500 / 4000) < 0.06 and abs(a_in_b - 0.75) < 0.06 and abs(b_in_a - 1500 / 3500) < 0.06
    assert fingerprints.compare_rows(["", ""], ["", fa])[0].tolist() == [1.0, 0.0]
    df = spark.createDataFrame([(fa, fb), (None, fa)], "a string, b string")
    got = [x[0] for x in df.select(fingerprints.merge(F.col("a"), F.col("b"))).collect()]
    assert fingerprints.compare_rows([got[0]], [fab])[0][0] > 0.98 and got[1] == fa
    df = spark.createDataFrame([(fa, fa), (fa, None)], "a string, b string")
    assert [x[0].likeness for x in df.select(fingerprints.likeness(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0]


@pytest.mark.parametrize("weighted", [False, True])
def test_dart_signatures_agree_with_weighted_jaccard(weighted):
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2 ** 63, 300, dtype=np.int64).astype(np.uint64)
    a, b = np.sort(values[:200]), np.sort(values[60:])
    wa = rng.integers(1, 6, 200).astype(float) if weighted else np.ones(200)
    wb = rng.integers(1, 6, 240).astype(float) if weighted else np.ones(240)
    da, db = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    every = set(da) | set(db)
    truth = sum(min(da.get(x, 0), db.get(x, 0)) for x in every) / sum(max(da.get(x, 0), db.get(x, 0)) for x in every)
    off = np.array([0, 200, 440, 440])
    sig = minhash.signatures(np.concatenate([a, b]), off, np.concatenate([wa, wb]) if weighted else None, k=2000)
    assert abs((sig[0] == sig[1]).mean() - truth) < 0.04
    assert (sig[2] == 0).all() and (sig[:2] != 0).all()


def _components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_match_union_find(spark):
    r = random.Random(5)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {x.node: x.root for x in components.stars(df).collect()}
    want = _components(341, links)
    assert got == {i: v for i, v in enumerate(want) if v != i}
    assert components.stars(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def _near_rows():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    rows = []
    for i in range(60):
        base = [word() for _ in range(r.randint(3, 120))]
        rows.append(" ".join(base))
        for _ in range(r.randint(0, 5)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = word()
            rows.append(" ".join(copy) if r.random() < 0.7 else " ".join(base))
    shared = " ".join(word() for _ in range(60))
    rows += [shared + " " + " ".join(word() for _ in range(r.randint(10, 40))) for _ in range(30)]
    return rows + ["", None, " \n", "ab", "ab", "AB"]


def test_near_duplicate_classes_match_brute_force(spark):
    rows = _near_rows()
    sets = [shingles(t) for t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] == sets[j] or
             (sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))]
    want = _components(len(rows), links)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(rows)], SCHEMA).repartition(5)
    got = {x.doc_id: x.class_id for x in minhash.classes(df).collect()}
    assert got == dict(enumerate(want))
    kept = minhash.one_per_class(df)
    assert kept.columns == df.columns and sorted(x.doc_id for x in kept.collect()) == sorted(set(want))


@pytest.mark.parametrize("most", [2, 23, 24, 25, 10 ** 9])
def test_regrouping_of_large_buckets_changes_no_class(spark, monkeypatch, most):
    rows = _near_rows()[:120]
    sets = [shingles(t) for t in rows]
    want = _components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] == sets[j] or
                                   (sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))])
    monkeypatch.setattr(minhash, "BUCKET_ROWS", most)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(rows)], SCHEMA)
    assert {x.doc_id: x.class_id for x in minhash.classes(df).collect()} == dict(enumerate(want))


def test_parity_maps_never_differ_in_more_bits_than_their_sets_in_elements():
    r = np.random.default_rng(3)
    pool = r.integers(0, 2 ** 63, 6000).astype(np.uint64)
    sets = [np.sort(r.choice(pool, n, replace=False)) for n in (0, 1, 2, 150, 150, 1400, 1500, 5000)]
    sets.append(np.sort(np.append(sets[3][1:], np.uint64(7))))
    off = np.cumsum([0] + [len(s) for s in sets])
    maps = minhash.parity_maps(np.concatenate(sets), off)
    for i, s in enumerate(sets):
        want = 0
        for h in text.mix64(s):
            want ^= 1 << (minhash.PARITY - 1 - int(h) % minhash.PARITY)
        assert b"".join(int(w).to_bytes(8, "big", signed=True) for w in maps[i]) == want.to_bytes(minhash.PARITY // 8, "big")
        for j in range(i):
            apart = sum(((int(a) ^ int(b)) & (2 ** 64 - 1)).bit_count() for a, b in zip(maps[i], maps[j], strict=True))
            assert apart <= len(np.setxor1d(s, sets[j]))
    close = sum(((int(a) ^ int(b)) & (2 ** 64 - 1)).bit_count() for a, b in zip(maps[3], maps[-1], strict=True))
    assert close in (0, 2)


def _middle_copies(seed, middles):
    """Two texts that differ in their last word, and between them copies with 17 new words each (similarity 0.81)."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(204)]
    out = [base]
    for _ in range(middles):
        copy = list(base)
        at = 5 + r.randrange(160)
        copy[at:at + 17] = [f"v{r.randrange(10 ** 6)}" for _ in range(17)]
        out.append(copy)
    return [" ".join(c) for c in out + [base[:-1] + ["end"]]]


def test_near_duplicate_classes_of_a_table_of_doubled_rows_match_brute_force(spark):
    # these seeds have copies that only buckets of the same size, smallest and largest member bring together
    rows = [t for seed, n in ((148, 2), (3, 3), (29, 4), (12, 6)) for t in _middle_copies(seed, n)]
    sets = [shingles(t) for t in rows]
    want = _components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    assert len(set(want)) == 4
    once = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(rows)], SCHEMA)
    twice = once.unionByName(once).repartition(3)
    assert sorted((x.doc_id, x.class_id) for x in minhash.classes(twice).collect()) == sorted(2 * list(enumerate(want)))
    assert sorted(x.doc_id for x in minhash.one_per_class(twice).collect()) == sorted(set(want))


def test_texts_that_share_a_doc_id_are_documents_of_their_own(spark):
    r = random.Random(4)
    one, two = ([f"w{r.randrange(10 ** 6)}" for _ in range(80)] for _ in range(2))
    texts = [" ".join(w) for w in (one, two, one[:-1] + ["end"], two[:-1] + ["end"], one)]
    rows = [(i, t, n, "x") for n, (i, t) in enumerate(zip((1, 1, 2, 3, 1), texts, strict=True), 10)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, SCHEMA).repartition(2)
        got = minhash.classes(df).collect()
        assert sorted(x.doc_id for x in got) == [1, 1, 1, 2, 3] and len({(x.key, x.class_id) for x in got}) == 4
        assert sorted(sum(x.class_id == c for x in got) for c in {x.class_id for x in got}) == [2, 3]
        kept = minhash.one_per_class(df)
        assert kept.columns == df.columns
        assert sorted((x.doc_id, x.text, x.n_chars) for x in kept.collect()) == sorted([(1, texts[0], 10), (1, texts[1], 11)])


def test_near_duplicates_handle_null_ids_repeated_rows_and_empty_tables(spark):
    assert minhash.classes(spark.createDataFrame([], SCHEMA)).count() == 0
    t = "one two three four five six seven"
    df = spark.createDataFrame([(None, t, 1, "x"), (None, t, 1, "x"), (5, t, 1, "x"), (5, t, 1, "x"), (None, "other text", 1, "x")], SCHEMA)
    got = minhash.classes(df).collect()
    assert len(got) == 5 and len({x.class_id for x in got}) == 2
    assert minhash.one_per_class(df).count() == 2


def test_a_large_group_of_copies_and_a_few_others_cost_no_square(spark):
    """Copies that share a passage with other documents: links as by brute force (weighted darts too)."""
    r = random.Random(12)
    word = lambda: f"w{r.randrange(10 ** 6)}"
    passage = [word() for _ in range(50)]
    base = passage + [word() for _ in range(70)]
    rows = []
    for _ in range(60):
        copy = list(base)
        copy[r.randrange(50, 120)] = word()
        rows.append(" ".join(copy))
    rows += [" ".join(passage + [word() for _ in range(r.randint(8, 60))]) for _ in range(50)]
    sets = [shingles(t) for t in rows]
    want = _components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(rows)], SCHEMA)
    for weighted in (False, True):
        assert {x.doc_id: x.class_id for x in minhash.classes(df, weighted=weighted).collect()} == dict(enumerate(want))


def test_one_per_class_passes_columns_of_any_name_and_type(spark):
    rows = [(1, "a b c d e f", "x", {"k": 2}, 7), (2, "a b c d e f", "y", {"k": 1}, 8), (3, "other words altogether here now", None, None, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _key string, tags map<string, int>, key int")
    got = minhash.one_per_class(df)
    assert got.columns == df.columns and sorted(tuple(r) for r in got.collect()) == [rows[0], rows[2]]


def test_near_duplicates_run_with_small_arrow_batches(spark, monkeypatch):
    """Texts and sets reach the workers in batches of bounded rows and bytes, and the session's settings come back."""
    names = [f"spark.sql.execution.arrow.{k}" for k in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before, seen = [spark.conf.get(k) for k in names], []

    def linked(keyed, *rest):
        seen.extend(spark.conf.get(k) for k in names)
        sizes = keyed.coalesce(1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
        seen.append(max(r["n"] for r in sizes.collect()))
        raise ValueError("seen")
    monkeypatch.setattr(minhash, "_linked", linked)
    monkeypatch.setattr(minhash, "BATCH_ROWS", 7)
    docs = spark.range(0, 50, 1, 1).selectExpr("id as doc_id", "cast(id as string) as text")
    with pytest.raises(ValueError):
        minhash.classes(docs)
    assert seen == ["7", str(minhash.BATCH_BYTES), 7] and [spark.conf.get(k) for k in names] == before


def test_texts_outside_open_buckets_are_not_shuffled(spark, monkeypatch):
    docs = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("key"), F.lit("a text").alias("text"))
    docs = docs.unionByName(docs.where("key < 100"))      # repeated and null keys
    met = spark.createDataFrame([(6,), (6,), (None,), (902,), (-5,)], "key bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = minhash.marked(docs, met)
        assert sorted(r.key for r in got.where("key is not null").collect()) == [6, 6, 902]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and not [x for x in plan.splitlines() if "Exchange hash" in x and "text" in x]
        monkeypatch.setattr(minhash, "MARK_WORDS", 1)     # a full bitmap keeps too much, never too little
        assert {6, 902} <= {r.key for r in minhash.marked(docs, met).collect()}
        made = []
        real = minhash.marked
        monkeypatch.setattr(minhash, "marked", lambda rows, keys: made.append(real(rows, keys)) or made[-1])
        texts = ["a b c d e f g h i j k l", "a b c d e f g h i j k l m", "other words stand here and here too", None, "a b"]
        rows = spark.createDataFrame([(i, t, 0, "") for i, t in enumerate(texts)], SCHEMA)
        assert {x.doc_id: x.class_id for x in minhash.classes(rows).collect()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}
        assert "text" in made[0].columns and [r.key for r in made[0].collect()] == [0, 1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
