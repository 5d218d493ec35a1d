"""Alignment, chat formatting and periodic runs against brute force and round trips."""

import binascii
import hashlib
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from candlewick.llm import alignment, chat, periodic, queries
from candlewick.llm.text import utf8_buffers
from candlewick.sources.tables import table

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


# --- periodic runs ----------------------------------------------------------------------------------------------

def _runs(w, min_words=6, min_periods=4):
    """Every maximal stretch of every lag, kept if the lag is its smallest period."""
    out = []
    for q in range(1, len(w)):
        i = q
        while i < len(w):
            if w[i] == w[i - q]:
                start = i
                while i < len(w) and w[i] == w[i - q]:
                    i += 1
                out.append((start - q, i - start + q, q))
            else:
                i += 1
    smallest = lambda s, n, q: not any(all(w[k] == w[k - p] for k in range(s + p, s + n)) for p in range(1, q))
    return sorted((r for r in out if r[1] >= max(min_words, min_periods * r[2]) and smallest(*r)), key=lambda r: (r[0], r[2]))


def _repetitive(rnd):
    letters, w = rnd.choice([1, 2, 3, 5]), []
    for _ in range(rnd.randint(0, 5)):
        w += [rnd.randrange(letters) for _ in range(rnd.randint(1, 9))] * rnd.randint(1, 7)
        if rnd.random() < .4:
            w = w * rnd.randint(1, 5)
        w = w[:200]
    return w


@pytest.mark.parametrize("limits", [(6, 4), (1, 2), (20, 3)])
def test_runs_match_brute_force(limits):
    rnd, found = random.Random(sum(limits)), 0
    for _ in range(200):
        w = _repetitive(rnd)
        want = _runs(w, *limits)
        assert periodic.find_runs(w, *limits) == want
        found += len(want)
    assert found > 50


def test_one_word_over_and_over_costs_no_square():
    w = [b"a"] * 60_000
    assert periodic.find_runs(w) == [(0, 60_000, 1)]
    assert periodic.find_runs((w[:999] + [b"b"]) * 50)[-1] == (49_000, 999, 1)


def test_best_run_compares_exact_fractions():
    runs = [(0, 13, 3), (20, 26, 6), (60, 9, 2), (80, 9, 2)]
    assert periodic.best_run(runs) == (60, 9, 2)
    assert max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0])) == (60, 9, 2)
    assert periodic.best_run([]) is None


def _op13(doc_id, text):
    words = (text or "").encode().split()
    h = binascii.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = _runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_run_query_matches_brute_force_on_short_documents(spark):
    short = {(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
             if len((r.text or "").split()) < 150}
    got = {r.doc_id: tuple(r) for r in queries.op13_runs(spark, SF_SMALL).collect()}
    assert len(short) > 50 and len(got) == table(spark, SF_SMALL, "documents").count()
    for doc_id, text in short:
        assert got[doc_id] == _op13(doc_id, text)
    assert any(r[1] for r in got.values())


def test_runs_of_odd_rows(spark):
    rows = [(1, None, 7), (2, "", 7), (3, " \n\t ", 7), (None, "a b " * 20, 7), (4, "a b " * 20, 7), (4, "a b " * 20, 7), (5, "é " * 6 + "x", 7),
            (6, "x " * 100_000, 7)]
    df = spark.createDataFrame(rows, "id int, body string, words int")
    got = periodic.with_runs(df, "body").orderBy("id").collect()
    assert [len(r.repeats.runs) for r in got] == [1, 0, 0, 0, 1, 1, 1, 1] and all(r.words == 7 for r in got)
    by = {r.id: r.repeats for r in got}
    assert by[1].n_words == 0 and by[1].best is None and by[1].collapsed == "" and by[3].collapsed == ""
    assert by[4].collapsed == "a b" and tuple(by[4].best) == (0, 40, 2, 20_000)
    assert by[5].collapsed == "é x" and tuple(by[6].best) == (0, 100_000, 1, 100_000_000)
    assert periodic.with_runs(df.limit(0), "body").count() == 0
    with pytest.raises(ValueError):
        periodic.with_runs(df, "body", out="words")


# --- chat -------------------------------------------------------------------------------------------------------

CHAT = "conv_id bigint, turn bigint, role string, text string"
ODD = ["", "plain", "\\", "\\\\", "###", "### Assistant: hi", "a</turn>\n### user: b", "<image 1>", "\\<image 1>", "\\### Assistant: </turn> ok", "é\n\n#",
       "</turn", "<", "\\n", "####", " lead and trail "]


def _read_back(rows):
    """Plain digests of (conv_id, turn, role, text) rows."""
    convs = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is None, r[1] or 0, r[2] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    return {c: (len(v), sha("".join(f"{r}\n{t}\n" for r, t in v)), sum(len(t) for r, t in v if r == "assistant"),
                sha("".join(t for r, t in v if r == "assistant"))) for c, v in convs.items()}


def test_turns_come_back_from_the_template():
    for a in ODD:
        for role in ("user", "assistant", "a: b", "x\\", "#<", ""):
            one, spans, _ = chat.format_turn(role, [{"type": "text", "text": a}])
            assert list(chat.parse_turns(one + one)) == [(role, a)] * 2
            assert [chat.unescape(one[s:e]) for s, e in spans] == [a]
    with pytest.raises(ValueError):
        list(chat.parse_turns("### user: cut off"))


def test_parts_become_placeholders_with_references_and_tokens():
    parts = [{"type": "text", "text": "see <this> "}, {"type": "image", "ref": "s3a", "width": 57, "height": 28},
             {"type": "text", "text": " and "}, {"type": "audio", "ref": "b", "seconds": 1.01}, {"type": "document", "ref": None, "pages": 3},
             {"type": "video", "ref": "c"}, None, {"type": "image", "ref": "d"}]
    text, spans, found = chat.format_turn("assistant", parts)
    assert text == "### assistant: see \\<this> <image 1> and <audio 2><document 3><other 4><other 5><image 6></turn>\n"
    assert [(k, r, n) for k, r, _, n in found] == [("image", "s3a", 3), ("audio", "b", 26), ("document", None, 768), ("other", "c", 1),
                                                    ("other", None, 1), ("image", "d", 1)]
    assert all(text[at:].startswith(f"<{k} {i}>") for i, (k, _, at, _) in enumerate(found, 1))
    assert [chat.unescape(text[a:b]) for a, b in spans] == ["see <this> ", " and "]
    assert list(chat.parse_turns(text)) == [("assistant", "see <this>  and ")]


@pytest.mark.parametrize("limit", [40, 1 << 20])
def test_conversations_of_any_length_read_back(spark, limit):
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 2, 3, 4, None, 9, 9, 9, 9]), t, rnd.choice(["user", "assistant", "system", None]), rnd.choice([*ODD, None]))
            for t in range(900)]
    df = spark.createDataFrame(rows, CHAT).repartition(7).withColumn("lane", F.lit("x")).withColumn("done", F.lit(1))
    segments = chat.format_chat(df, limit)
    assert segments.agg(F.max(F.length("text"))).first()[0] <= limit + 200 or limit > 40
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(segments).collect()}
    assert got == _read_back(rows)


def test_formatted_length_and_attachments_over_segments(spark):
    part = [("text", "#1", None, None, None, None, None), ("image", None, "i", 56, 56, None, None)]
    rows = [(c, t, "assistant", part) for c in (1, 2) for t in range(50)]
    df = spark.createDataFrame(rows, f"conv_id int, turn int, role string, parts array<{chat.PART}>")
    got = chat.read_back(chat.format_chat(df, 100)).orderBy("conv_id").collect()
    size = len("### assistant: \\#1<image 1></turn>\n")
    assert [(r.n_turns, r.loss_chars, r.formatted_chars, r.n_attachments, r.attachment_tokens) for r in got] == [(50, 100, 50 * size, 50, 200)] * 2
    seg = chat.format_chat(df, 100).collect()
    for s in seg:
        assert all(s.text[a.at:].startswith("<image 1>") and a.ref == "i" for a in s.attachments)


def test_chat_query_reads_back_every_conversation(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    got = {r.conv_id: tuple(r)[1:5] for r in queries.op12_chat(spark, SF_SMALL).collect()}
    assert got == _read_back(rows)


def test_chat_of_repeated_null_and_no_rows(spark):
    rows = [(None, None, None, None), (None, None, None, None), (1, None, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.format_chat(spark.createDataFrame(rows, CHAT))).collect()}
    assert got == _read_back(rows) and got[None][0] == 2 and got[1][0] == 3
    assert chat.read_back(chat.format_chat(spark.createDataFrame([], CHAT))).count() == 0


# --- alignment --------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def coders():
    with open(alignment.A_PATH, "rb") as a, open(alignment.B_PATH, "rb") as b:
        return alignment.Coders(a.read(), b.read())


TEXTS = ["", None, " ", "a", "日本語のテキスト emoji 😀😀 x", "a▁b", "  two  spaces\n\nx ", " x <|endoftext|> </s><s><unk>", "it's 1234567 we'll", "-" * 400,
         "aé́ß ﬁ ǅ ɏ", "\t\r\n", "x" * 3000, "ĠĠ Ġ", "\x00\x1c\x1f a b c"]


def _plain(coders, text):
    """(groups as id lists, or [] where a tokenizer's bytes differ), cut by the set of common ends."""
    if not text:
        return []
    a = coders.library.encode(" " + text, add_special_tokens=False).ids
    b = coders.pieces.encode(text)
    raw = [[c.flat[c.at[i]:c.at[i + 1]].tobytes() for i in ids] for c, ids in ((coders.a, a), (coders.b, b))]
    if any(b"".join(r) != (" " + text).encode() for r in raw):
        return []
    ends = [np.cumsum([len(x) for x in r]).tolist() for r in raw]
    out, start = [], 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        out.append(tuple([i for i, e in zip(ids, es) if start < e <= cut] for ids, es in zip((a, b), ends)))
        start = cut
    return out


def _text(groups):
    return ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)


def _statistics(coders, rows):
    groups = [_plain(coders, t) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    held = Counter(p for c in links for p in c)
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    return sorted(((k, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in c.items()), sha(_text(g)) if g else "")
                   for (k, _), g, c in zip(rows, groups, links)), key=str)


def test_the_faster_path_cuts_like_the_library(coders, spark):
    texts = [r.text for r in table(spark, SF_SMALL, "documents").collect() if r.text] + [t for t in TEXTS if t]
    assert coders.fast is not None
    assert coders.encode(texts)[0] == [coders.library.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_groups_match_the_set_of_common_ends():
    rnd = random.Random(8)
    for _ in range(300):
        docs = []
        for _ in range(rnd.randint(0, 5)):
            n = rnd.randint(1, rnd.choice([3, 40, 400]))
            cuts = [sorted({*rnd.sample(range(1, n + 1), rnd.randint(0, min(n, rnd.choice([1, 5, 400])))), n}) for _ in range(2)]
            docs.append(cuts if rnd.random() < .9 else ([], []))
        base, a, b, a_off, b_off = 0, [], [], [0], [0]
        for x, y in docs:
            a += [base + e for e in x]
            b += [base + e for e in y]
            a_off.append(len(a))
            b_off.append(len(b))
            base += x[-1] if x else 0
        common = sorted(set(a) & set(b))
        want_a = [0, *[a.index(c) + 1 for c in common]]
        want_b = [0, *[b.index(c) + 1 for c in common]]
        got = alignment.align(*(np.array(v, np.int64) for v in (a, b, a_off, b_off)))
        assert got[0].tolist() == want_a and got[1].tolist() == want_b


def test_links_of_wide_groups_are_counted_alike(coders, monkeypatch):
    texts = [t for t in TEXTS] * 2
    data, off = utf8_buffers(pa.array(texts))
    plain = alignment.Aligned(coders, texts, data, off).links()
    monkeypatch.setattr(alignment, "PRODUCT", 1)
    for x, y in zip(plain, alignment.Aligned(coders, texts, data, off).links(), strict=True):
        assert x.tolist() == y.tolist()


def test_link_statistics_match_brute_force(spark, coders):
    texts = [r.text for r in table(spark, SF_SMALL, "documents").limit(120).collect()] + TEXTS + TEXTS
    rows = list(enumerate(texts)) + [(None, "null id"), (3, "again"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("pair", F.lit(1)).withColumn("held", F.lit("x")).repartition(3)
    got = alignment.link_statistics(df, block_bytes=20_000)
    assert sorted(map(tuple, got.collect()), key=str) == _statistics(coders, rows)


def test_alignment_column_holds_every_group(spark, coders):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    for r in alignment.with_alignment(df).collect():
        want = _plain(coders, r.text)
        a = [x for g, _ in want for x in g]
        b = [x for _, g in want for x in g]
        assert (r.alignment.a, r.alignment.b, r.alignment.a_counts, r.alignment.b_counts) == (
            a, b, [len(g) for g, _ in want], [len(g) for _, g in want])
    with pytest.raises(ValueError):
        alignment.with_alignment(df, out="i")


def test_alignment_of_no_rows_and_of_texts_without_tokens(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.link_statistics(empty).count() == 0
    got = alignment.link_statistics(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]

