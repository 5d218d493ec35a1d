"""Main-text extraction with a recurrent block labeller.

A page is cut into leaf blocks; a bidirectional LSTM reads, for each block, the mean embedding of its hashed
tag-path tokens (tags, words of class / id / role, share of link text, size) and of its hashed words, and
labels every block with the whole page as context. The text is the blocks labelled as article, in page order.

No labels are given, so the training pages are weakly labelled: a bounded sample of the table's own pages,
and pages laid out at random from the same blocks' sentences, each block labelled by the kind of container it
was put in (or, on real pages, by the names in its path). Names are dropped at random in training, so that
layout, links and neighbours count too. Prediction covers every block of every page.

Defined results: a null, empty or text-free page gives the empty text; equal pages give equal texts; without
any training page the random layouts alone are used, with words of their own.
"""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.htmlblocks import leaf_blocks
from candlewick.llm.lstm import Adam, Bag, BiLSTM
from candlewick.llm.text import U, lower, range_hashes, utf8_buffers, word_bounds

PATH_ROWS, WORD_ROWS = 1 << 12, 1 << 11
SAMPLE_PAGES, MADE_PAGES = 150, 450       # training pages: from the table (in expectation), laid out at random
BATCH_HTML = 4 << 20

# words that name a container's role
ASIDE = frozenset("""nav navbar navigation menu menus header masthead topbar footer foot sidebar aside widget widgets ad ads adv advert
advertisement adverts sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr notice alert popup modal overlay
newsletter subscribe signup login search form comment comments commentlist respond disqus reply replies discussion responses related
recommended recommendations share sharing social breadcrumb breadcrumbs pagination pager toolbar legal copyright disclaimer button
complementary contentinfo""".split())
ARTICLE = frozenset("article main content post entry story text body".split())


def weak_label(path: str) -> int:
    """1 unless the path names a container that is not article text."""
    for element in path.split("|")[0].split(">"):
        tag, *names = element.split(".")
        if tag in ("nav", "aside", "footer", "form", "menu", "button", "select", "dialog"):
            return 0
        if tag == "header" and "article" not in path and "main" not in path:
            return 0
        if tag not in ("html", "body") and ASIDE.intersection(names):
            return 0
    return 1


class PathIds:
    """Hashed tokens of a path; each distinct path is hashed once."""

    def __init__(self, most: int = 100_000):
        self.known: dict[str, np.ndarray] = {}
        self.most = most

    def __call__(self, path: str) -> np.ndarray:
        got = self.known.get(path)
        if got is None:
            names, *shape = path.split("|")
            tokens = []
            elements = [e for e in names.split(">") if e]
            for e in elements:
                tag, *words = e.split(".")
                tokens += [f"<{tag}", *("." + w for w in words)]
            tokens += [f"last<{elements[-1].split('.')[0]}" if elements else "last<", *shape]
            got = np.array(sorted({zlib.crc32(t.encode()) % PATH_ROWS for t in tokens}), np.int64)
            if len(self.known) < self.most:
                self.known[path] = got
        return got


def word_bags(texts: list[str]) -> Bag:
    data, off = utf8_buffers(pa.array(texts, pa.large_string()))
    data = lower(data)
    start, end, woff = word_bounds(data, off)
    return Bag((range_hashes(data, start, end) % U(WORD_ROWS)).astype(np.int64), woff)


def path_bag(rows: list[np.ndarray]) -> Bag:
    return Bag(np.concatenate(rows) if rows else np.empty(0, np.int64), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64))


# --- random layouts -------------------------------------------------------------------------------------------

class Layout:
    """Random pages whose blocks' labels are known; '\x01' and '\x02' mark article and other text."""

    def __init__(self, sentences: list[str], seed: int):
        self.r = random.Random(seed)
        self.sentences = sentences or ["alpha beta gamma.", "delta epsilon zeta eta theta."]

    def say(self, low: int, high: int) -> str:
        return " ".join(self.r.choice(self.sentences) for _ in range(self.r.randint(low, high)))

    def word(self) -> str:
        return self.r.choice(self.r.choice(self.sentences).split() or ["x"])

    def name(self, *names: str) -> str:
        kind = self.r.choice(["class", "class", "id"])
        return f' {kind}="{self.r.choice(names)}"' if self.r.random() < 0.85 else ""

    def links(self, n: int, mark: str) -> str:
        items = "".join(f'<li><a href="/{i}">{mark}{self.word()}</a></li>' for i in range(n))
        return f"<ul>{items}</ul>" if self.r.random() < 0.7 else "".join(f'<a href="/{i}">{mark}{self.word()}</a> ' for i in range(n))

    def other(self) -> str:
        """Something that is not article text."""
        r, no = self.r, "\x02"
        kind = r.randrange(9)
        if kind == 0:
            return f"<nav>{self.links(r.randint(2, 8), no)}</nav>" if r.random() < 0.6 else \
                f"<div{self.name('menu', 'nav', 'main-menu', 'navbar', 'breadcrumb')}>{self.links(r.randint(2, 8), no)}</div>"
        if kind == 1:
            return f"<header{self.name('site-header', 'header', 'masthead')}><div>{no}{self.say(1, 1)}</div><p>{no}{self.word()}</p></header>"
        if kind == 2:
            return f"<footer{self.name('footer', 'site-footer')}><p>{no}&copy; {self.word()} &middot; {self.say(1, 2)}</p></footer>" if r.random() < 0.5 else \
                f"<footer>{no}&copy; {self.word()} &middot; {self.say(1, 1)}</footer>"
        if kind == 3:
            tag = r.choice(["aside", "div", "section"])
            return f"<{tag}{self.name('sidebar', 'widget', 'related', 'side-bar', 'recommended') if tag != 'aside' else ''}><h3>{no}{self.word()}</h3><p>{no}{self.say(1, 3)}</p>{self.links(r.randint(0, 4), no)}</{tag}>"
        if kind == 4:
            return f"<div class=\"{r.choice(['cookie-notice', 'cookie-banner', 'notice', 'consent', 'alert', 'gdpr', 'popup'])}\"><p>{no}{self.say(1, 3)}</p></div>" if r.random() < 0.5 else \
                f"<div class=\"{r.choice(['cookie-notice', 'notice', 'banner', 'alert'])}\">{no}{self.say(1, 2)}</div>"
        if kind == 5:
            return f"<div class=\"{r.choice(['ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'ad-slot', 'banner-ad'])}\">{no}{self.say(1, 3)}</div>"
        if kind == 6:
            return f"<form action=\"/\"><label>{no}{self.word()}</label><input type=\"text\"><p>{no}{self.say(1, 2)}</p><button>{no}{self.word()}</button></form>"
        if kind == 7:
            tag, item = r.choice([("section", "div"), ("div", "div"), ("ol", "li"), ("ul", "li")])
            row = r.choice(["comment", "reply", "comment-body", "item"])
            body = "".join(f"<{item} class=\"{row}\"><p>{no}{self.say(1, 4)}</p></{item}>" if r.random() < 0.7 else
                           f"<{item}>{no}{self.say(1, 3)}</{item}>" for _ in range(r.randint(1, 4)))
            named = r.choice(["comments", "comment-list", "reader-comments", "respond", "discussion", "user-comments"])
            head = f"<h3>{no}{self.word()}</h3>" if tag in ("section", "div") else ""
            return f"<{tag} {r.choice(['id', 'class'])}=\"{named}\">{head}{body}</{tag}>"
        return f"<div class=\"{r.choice(['share', 'social', 'newsletter', 'subscribe', 'pagination', 'toolbar'])}\">{self.links(r.randint(1, 4), no)}<span>{no}{self.say(1, 1)}</span></div>"

    def article(self) -> str:
        r, yes = self.r, "\x01"
        parts = []
        for _ in range(r.randint(1, 10)):
            k = r.random()
            if k < 0.72:
                parts.append(f"<p>{yes}{self.say(1, 8) if r.random() < 0.8 else self.word()}" + ("</p>" if r.random() < 0.9 else ""))
            elif k < 0.80:
                n = r.choice("234")
                parts.append(f"<h{n}>{yes}{self.say(1, 1)}</h{n}>")
            elif k < 0.86:
                tag = r.choice(["ul", "ol"])
                parts.append(f"<{tag}>" + "".join(f"<li>{yes}{self.say(1, 2)}</li>" for _ in range(r.randint(2, 4))) + f"</{tag}>")
            elif k < 0.90:
                parts.append(f"<blockquote><p>{yes}{self.say(1, 3)}</p></blockquote>")
            elif k < 0.93:
                parts.append(f"<div>{yes}{self.say(1, 4)}</div>")
            elif k < 0.95:
                parts.append("<table><tr>" + "".join(f"<td>{yes}{self.word()}</td>" for _ in range(3)) + "</tr></table>")
            elif k < 0.97:
                parts.append(f"<p><b>{yes}{self.say(1, 1)}<br><p>{yes}{self.say(1, 5)}</p>")
            else:
                parts.append(f"<p>{yes}{self.say(1, 2)} <a href=\"/x\">{self.say(1, 1)}</a></p>")
            if r.random() < 0.08:
                parts.append(self.other())
        title = f"<h1>{yes}{self.say(1, 1)}</h1>" if r.random() < 0.85 else ""
        if title and r.random() < 0.2:
            title = f"<header>{title}</header>"
        inner = title + "".join(parts) + (self.other() if r.random() < 0.15 else "")
        k = r.random()
        if k < 0.4:
            return f"<article>{inner}</article>"
        if k < 0.55:
            return f"<main>{inner}</main>"
        if k < 0.65:
            return f"<main><article>{inner}</article></main>"
        names = ["content", "post", "post-content", "entry-content", "article-body", "story", "main-content", "text"]
        if k < 0.9:
            return f"<div{self.name(*names)}>{inner}</div>"
        return f"<section>{inner}</section>" if k < 0.95 else inner

    def page(self) -> str:
        r = self.r
        before = [self.other() for _ in range(r.randint(0, 3))]
        after = [self.other() for _ in range(r.randint(0, 3))]
        body = "".join(before) + self.article() + "".join(after)
        if r.random() < 0.4:
            body = f"<div{self.name('wrapper', 'page', 'container', 'site', 'layout')}>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.word()}</title></head><body>{body}" + ("</body></html>" if r.random() < 0.9 else "")

    def labelled(self) -> list[tuple[str, str, int]]:
        """(text, path, label) of a random page's blocks."""
        out = []
        for text, path in leaf_blocks(self.page()):
            marks = [m for m in text if m in "\x01\x02"]
            out.append((re.sub("[\x01\x02]", "", text), path, int(bool(marks) and marks[0] == "\x01")))
        return out


# --- training and prediction ----------------------------------------------------------------------------------

def fit(pages: list[str], made: int = MADE_PAGES, rounds: int = 6, seed: int = 11, forget: float = 0.12) -> BiLSTM:
    """Train on weakly labelled ``pages`` and ``made`` random layouts of their sentences."""
    rng = np.random.default_rng(seed)
    real = [[(t, p, weak_label(p)) for t, p in leaf_blocks(h)] for h in pages]
    sentences = [s for page in real for t, _, y in page if y for s in re.findall(r"[^.!?]+[.!?]", t)[:40]][:5000]
    layout = Layout(sentences, seed)
    sequences = [s[:200] for s in real + [layout.labelled() for _ in range(made)] if s]
    net = BiLSTM(PATH_ROWS, WORD_ROWS, seed=seed)
    opt = Adam(net.p)
    ids = PathIds()
    prepared = [([ids(p) for _, p, _ in s], [t for t, _, _ in s], np.array([y for _, _, y in s], np.float32)) for s in sequences]
    for turn in range(rounds):
        opt.rate = 0.02 * 0.6 ** turn
        order = sorted(rng.permutation(len(prepared)), key=lambda i: len(prepared[i][1]) // 8)
        chunks = [order[i:i + 24] for i in range(0, len(order), 24)]
        for c in rng.permutation(len(chunks)):
            part = [prepared[i] for i in chunks[c]]
            rows = [r if rng.random() > 0.5 else r[rng.random(len(r)) > forget] for s in part for r in s[0]]
            off = np.concatenate([[0], np.cumsum([len(s[1]) for s in part])])
            _, grads = net.gradients(path_bag(rows), word_bags([t for s in part for t in s[1]]), off, np.concatenate([s[2] for s in part]))
            opt.step(grads)
    return net


class Extractor:
    def __init__(self, net: BiLSTM):
        self.net, self.ids = net, PathIds()

    def label(self, pages: list[str]) -> tuple[list[tuple[str, str]], np.ndarray, np.ndarray]:
        """(blocks of all pages, page offsets, probability that a block is article text)."""
        blocks, off = [], [0]
        for h in pages:
            blocks += leaf_blocks(h)
            off.append(len(blocks))
        words = word_bags([t for t, _ in blocks])
        paths = path_bag([self.ids(p) for _, p in blocks])
        x = np.concatenate([paths.mean(self.net.p["path"]), words.mean(self.net.p["word"])], 1)
        return blocks, np.array(off), self.net.predict(x, np.array(off))

    def texts(self, pages: list[str]) -> list[str]:
        blocks, off, p = self.label(pages)
        keep = p >= 0.5
        return ["\n".join(blocks[j][0] for j in range(a, b) if keep[j]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> BiLSTM:
    """Fit on about ``sample`` pages chosen by a hash of their html, plus random layouts."""
    total = pages.count()
    rate = int((1 << 30) * min(1.0, sample / max(total, 1)))
    rows = (pages.where(F.col("html").isNotNull()).select("html", F.xxhash64("page_id", F.lit(5)).alias("h"))
            .where(F.pmod("h", F.lit(1 << 30)) < rate).orderBy("h", "html").select("html").toArrow())
    return fit(rows.column(0).to_pylist()[:4 * sample])


def extract(html: Column, net: BiLSTM, spark) -> Column:
    """Main text of an html column."""
    shared = spark.sparkContext.broadcast(net)
    cell: list[Extractor] = []

    @F.arrow_udf("string")
    def udf(h: pa.Array) -> pa.Array:
        if not cell:
            cell.append(Extractor(shared.value))
        _, off = utf8_buffers(h)
        out: list[str] = []
        while len(out) < len(h):
            lo = len(out)
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + BATCH_HTML, "right")) - 1)
            out += cell[0].texts(h.slice(lo, hi - lo).fill_null("").to_pylist())
        return pa.array(out, pa.string())
    return udf(html)


def with_main_text(pages: DataFrame, net: BiLSTM, html: str = "html", out: str = "text") -> DataFrame:
    return pages.withColumn(out, extract(F.col(html), net, pages.sparkSession))
