"""Language, toxicity, url and extraction models: exact parts by brute force, learned parts on held-out rows."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from candlewick.llm import extraction, htmlblocks, language, lstm, queries, toxicity, urls
from candlewick.sources.tables import table

SF = SF_SMALL.replace("sf0.001", "sf0.01")


# --- language ---------------------------------------------------------------------------------------------------

def _symbols():
    s = np.full(256, 63, np.uint8)
    s[list(b" abcdefghijklmnopqrstuvwxyz")] = np.arange(1, 28)
    return s


def test_code_lengths_match_a_plain_context_tree():
    symbol, order = _symbols(), 3
    train, test = "abra cadabra abracadabra simsalabim", ["cadabra", "zzz q", "", "ab"]
    data, off = np.frombuffer(train.encode(), np.uint8), np.array([0, len(train)])
    s, c = language.codes(data, off, symbol, order)
    key, n = np.unique((c.astype(np.int64) << 6) | s, return_counts=True)
    model = language.build(["x"], symbol, {0: (key, n)}, order, least=1)
    got, _ = model.lengths(pa.array(test))
    padded = [0] * order + s.tolist()
    count: dict[tuple, dict] = {}
    for i in range(order, len(padded)):
        for k in range(order + 1):
            d = count.setdefault(tuple(padded[i - k:i]), {})
            d[padded[i]] = d.get(padded[i], 0) + 1

    def law(context, x):
        below = law(context[1:], x) if context else 1 / 64
        d = count.get(context)
        return below if not d else (d.get(x, 0) + len(d) * below) / (sum(d.values()) + len(d))
    for row, t in enumerate(test):
        sym = [0] * order + [int(symbol[b]) for b in t.encode()]
        want = -sum(math.log2(law(tuple(sym[i - order:i]), sym[i])) for i in range(order, len(sym)))
        assert abs(got[row, 0] - want) < 1e-3 * max(1, want)


def test_language_is_right_on_held_out_rows_and_defined_for_odd_ones(spark):
    docs = table(spark, SF, "documents")
    got = queries.op4_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(got) > 100 and sum(x.lang == x.lang_pred for x in got) / len(got) > 0.98
    assert all(0 <= x.score <= 1 for x in got)
    model = language.train(docs)
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "123 !?", None), (4, "the and that " * 20000, None), (None, "x", "k")],
                                "doc_id bigint, text string, language string")
    rows = {x.doc_id: x._l for x in language.with_language(odd, model, out="_l").collect()}
    assert [rows[i].lang for i in (1, 2, 3)] == ["und"] * 3 and rows[1].score == 0 and rows[4].lang == "en" and rows[None].lang
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    none = language.train(empty)
    assert language.with_language(empty, none).count() == 0
    assert language.with_language(odd, none, out="_l").where("_l.lang <> 'und'").count() == 0


# --- toxicity ---------------------------------------------------------------------------------------------------

def test_noisy_or_matches_a_plain_loop():
    rng = np.random.default_rng(0)
    m = toxicity.Model(rng.normal(0, 2, 1 << toxicity.BITS), -2.0, -4.0)
    texts = ["You fool. You Fool! fine\nday", "", None, "...", "ok ok ok?", "a. b. c. " * 50]
    score, top, start, stop = m.score(pa.array(texts))

    def bucket(w):
        d = np.frombuffer(w.encode(), np.uint8)
        return int(toxicity.range_hashes(d, np.array([0]), np.array([len(d)]))[0] >> np.uint64(64 - toxicity.BITS))
    import re
    for i, t in enumerate(texts):
        clean, best = 1 / (1 + math.exp(-4.0)), 0.0
        for s in re.findall(r"[^.!?\n]*[.!?\n]|[^.!?\n]+$", t or ""):
            words = set(re.findall(r"[a-z]+", s.lower()))
            if words:
                p = 1 / (1 + math.exp(-(-2.0 + sum(float(m.weights[bucket(w)]) for w in words))))
                clean, best = clean * (1 - p), max(best, p)
        assert abs(score[i] - (1 - clean)) < 1e-6 and abs(top[i] - best) < 1e-6
    assert texts[0].encode()[start[0]:stop[0]].decode().strip(" .!\n")


def test_fit_finds_the_offending_words():
    r = random.Random(2)
    word = lambda: r.choice(["red", "green", "blue", "warm", "cold", "tall", "low", "near"])
    texts, y = [], []
    for i in range(400):
        s = [" ".join(word() for _ in range(6)) + "." for _ in range(8)]
        bad = r.random() < 0.25
        if bad:
            s[r.randrange(8)] = f"{word()} {r.choice(['vile', 'rotten'])} {word()}."
        texts.append(" ".join(s))
        y.append(int(bad))
    m = toxicity.fit(texts, np.array(y))
    s, _, a, b = m.score(pa.array(texts))
    assert (((s >= 0.3).astype(int)) == np.array(y)).mean() > 0.99
    i = y.index(1)
    assert any(w in texts[i][a[i]:b[i]] for w in ("vile", "rotten"))
    assert toxicity.fit([], np.array([])).score(pa.array(["x"]))[0][0] < 1e-9
    assert toxicity.fit(["x"], np.array([1])).score(pa.array(["x"]))[0][0] > 0.99


def test_toxicity_query_on_held_out_rows(spark):
    got = queries.op6_toxicity(spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out and toxic is not null").collect()
    hit = [x for x in got if x.predicted == 1]
    assert sum(x.toxic for x in hit) >= 0.8 * len(hit) and all(0 <= x.score <= 1 for x in got)
    assert sum(x.predicted for x in got if x.toxic) >= 0.4 * sum(x.toxic for x in got)


# --- urls -------------------------------------------------------------------------------------------------------

def test_segmentation_is_the_best_of_all_cuts():
    seg = urls.Segmenter({"cheap": 50, "pills": 40, "che": 5, "ap": 5, "news": 60, "paper": 30, "newspaper": 20, "a": 9})
    unknown = -math.log(seg.total) - math.log(10)

    def cuts(t):
        return [[t[:i], *rest] for i in range(1, len(t) + 1) for rest in cuts(t[i:])] if t else [[]]

    def total(ws):
        return sum(seg.cost.get(w, unknown - 2.5 * len(w)) for w in ws)
    for t in ("cheappills", "newspaper", "xcheapy", "apche", "q", ""):
        short = [c for c in cuts(t) if all(len(w) <= seg.longest for w in c)]
        assert abs(total(seg.cut(t)) - max(map(total, short))) < 1e-9
    assert seg.cut("cheappills") == ["cheap", "pills"]


def test_rules_and_url_parts(spark):
    rows = [("http://a.com/x?q#f", "a.com", "/x", "com/", "allow"), ("https://EXAMPLE.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
            ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
            ("x://b.net/es/", "b.net", "/es/", "net/es/", "block"), ("http://net/fr/?x", "net", "/fr/", "net/fr/", "block"),
            ("http://notnet/fr/", "notnet", "/fr/", None, None), ("http://a.com", "a.com", "", None, None), ("nothing", "", "", None, None),
            ("http://a.com#/en/", "a.com", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
            ("a://b://c.com/", "b:", "//c.com/", None, None), ("http://ÄA.com/é", "Äa.com", "/é", "com/", "allow")]
    df = spark.createDataFrame([(r[0], i) for i, r in enumerate(rows)], "url string, host int")
    h, p = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    rule, verdict = urls.match_rule(h, p)
    got = df.select("host", h.alias("h"), p.alias("p"), rule.alias("r"), verdict.alias("v")).orderBy("host").collect()
    for x, want in zip(got, rows, strict=True):
        assert (x.h, x.p, x.r, x.v) == want[1:]


def test_url_model_blocks_listed_names_and_leaves_others(spark):
    pages = table(spark, SF, "pages")
    model = urls.train(pages)
    tries = {"http://cheappills.org/a": "block", "http://free-casino.org/x": "block", "https://daily-news.org/en/1": "allow", "http://roads.org/": "allow"}
    df = spark.createDataFrame([(u,) for u in [*tries, None]], "url string")
    got = {x.url: x.url_verdict for x in urls.with_verdict(df, model).collect()}
    assert {u: got[u].verdict for u in tries} == tries and got[None].verdict == "allow" and got[None].host == ""
    assert urls.with_verdict(spark.createDataFrame([], "url string, host string"), model).count() == 0
    none = urls.train(spark.createDataFrame([], "url string, html string"))
    assert urls.with_verdict(df, none).count() == 5
    out = queries.op3_urls(spark, SF)
    assert out.count() == pages.count() and {"page_id", "host", "path", "rule", "verdict"} <= set(out.columns)


# --- extraction -------------------------------------------------------------------------------------------------

def test_gradients_match_finite_differences():
    net = lstm.BiLSTM(20, 15, path_dim=3, word_dim=2, hidden=3, dtype=np.float64)
    rng = np.random.default_rng(1)
    path = lstm.Bag(rng.integers(0, 20, 12), np.array([0, 2, 3, 5, 7, 10, 12]))
    word = lstm.Bag(rng.integers(0, 15, 9), np.array([0, 0, 2, 4, 5, 7, 9]))
    off, y = np.array([0, 4, 6]), np.array([1, 0, 1, 1, 0, 1.0])
    _, grads = net.gradients(path, word, off, y)
    for name, g in grads.items():
        for at in rng.integers(0, g.size, 6):
            i = np.unravel_index(at, g.shape)
            kept, loss = net.p[name][i], []
            for step in (1e-5, -1e-5):
                net.p[name][i] = kept + step
                loss.append(net.gradients(path, word, off, y)[0])
            net.p[name][i] = kept
            assert abs((loss[0] - loss[1]) / 2e-5 - g[i]) < 1e-6, name


def test_prediction_does_not_depend_on_the_batch():
    net = lstm.BiLSTM(20, 15)
    x = np.random.default_rng(2).normal(size=(30, 22)).astype(np.float32)
    off = np.array([0, 5, 5, 17, 30])
    whole = net.predict(x, off)
    alone = np.concatenate([net.predict(x[a:b], np.array([0, b - a])) for a, b in zip(off[:-1], off[1:]) if b > a])
    assert np.allclose(whole, alone, atol=1e-6)


def test_blocks_decode_references_and_skip_what_is_not_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body><!-- <p>no</p> --><script>var a="<p>no</p>";</script>
    <nav class="mainMenu"><ul><li><a href="a>b">Home</a><li><a href='x'>Two</a></ul></nav><p>One &amp; <b>t&eacute;o</b><br>x&nbsp; y
    <p>Next<p><div>&lt;tag&gt; 3 < 4</div><P CLASS=q>last &amp"""
    got = htmlblocks.leaf_blocks(page)
    assert [t for t, _ in got] == ["Home", "Two", "One & téo x y", "Next", "<tag> 3 < 4", "last &"]
    assert got[0][1].startswith(">html>body>nav.main.menu>ul>li|L3") and got[4][1].startswith(">html>body>div|")
    assert htmlblocks.leaf_blocks("") == [] and htmlblocks.leaf_blocks("just text") == [("just text", "|L0|S0")]
    assert htmlblocks.leaf_blocks("<p>cut <a hre") == [("cut", ">p|L0|S0")]


def test_blocks_keep_what_follows_or_stands_inside_embedded_elements():
    def texts(html):
        return [t for t, _ in htmlblocks.leaf_blocks(html)]
    for tag in ("svg", "math", "object", "iframe", "noscript", "textarea"):
        assert texts(f"<div><{tag} class='a'/><p>one</p></div><p>two</p>") == ["one", "two"]
        assert texts(f"<div><{tag} class='a'><p>one</p></div><p>two</p>") == ["one", "two"]
        assert texts(f"<p>one <{tag}>in</{tag}> two</p><p>three</p>") == ["one in two", "three"]
    assert texts("<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then <svg><path d='M0'/></svg>so</p>") == ["if x=1 then so"]
    assert texts("<title/><script src='x'/><p>one</p><script>var b = 1 > 0;</script><p>two</p>") == ["one", "two"]
    assert texts("<p>one</p><script>var c;") == ["one"]


@pytest.fixture(scope="module")
def net(spark):
    return extraction.train(table(spark, SF, "pages"))


def test_extraction_matches_the_article_of_the_tables_pages(spark, net):
    import html as h
    import re
    rows = table(spark, SF, "pages").collect()
    got = extraction.Extractor(net).texts([r.html for r in rows])
    bad = 0
    for r, text in zip(rows, got, strict=True):
        inner = r.html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(h.unescape(re.sub("<[^>]*>", " ", s)).split()) for s in re.split(r"</?(?:p|h1)>|<br>", inner)]
        bad += text != "\n".join(b for b in blocks if b)
    assert bad <= len(rows) // 100


def test_extraction_learned_layouts_it_has_not_seen(net):
    made = extraction.Layout(["Alpha beta gamma delta.", "One more thing said here, at some length and with care."], 77)
    right = total = 0
    ex = extraction.Extractor(net)
    for _ in range(80):
        page = made.labelled()
        if page:
            x = np.concatenate([extraction.path_bag([ex.ids(p) for _, p, _ in page]).mean(net.p["path"]),
                                extraction.word_bags([t for t, _, _ in page]).mean(net.p["word"])], 1)
            p = net.predict(x, np.array([0, len(page)])) >= 0.5
            right, total = right + int((p == np.array([y for _, _, y in page])).sum()), total + len(page)
    assert right / total > 0.93


def test_extraction_of_odd_pages(spark, net):
    long = "<body><article><p>" + "many words here and there. " * 40_000 + "</p></article></body>"
    df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "<nav></nav>", "k"), (4, long, "k"), (4, long, "k")], "page_id bigint, html string, text string")
    got = sorted((x.page_id, x.out or "") for x in extraction.with_main_text(df, net, out="out").collect())
    assert [t for _, t in got[:3]] == ["", "", ""] and got[3] == got[4] and len(got[3][1]) == len(long) - 45 - 1 or got[3][1].startswith("many")
    empty = spark.createDataFrame([], "page_id bigint, html string")
    assert extraction.with_main_text(empty, extraction.train(empty)).count() == 0



def test_folds(spark):
    got = {x.id: x.f for x in spark.range(200).select("id", toxicity.fold(F.col("id")).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 for i in range(200)}
