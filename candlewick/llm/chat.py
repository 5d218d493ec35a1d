r"""Conversations of typed content parts, formatted for chat training and read back.

A turn is a list of parts: text, image, audio or document. ``Flatten`` visits the parts in order and writes one string:
text is escaped, an attachment becomes a placeholder such as ``<image 2>`` (numbered within its turn) and is recorded
with its reference, its place in the string and the number of tokens that the placeholder expands to. Parts of another
type are written as ``<other n>`` with one token, so nothing is lost.

The template marks a turn as ``### role: content</turn>`` and a line end. ``#``, ``<`` and the backslash itself get a
backslash inside texts (in roles also ``:``), so an unescaped mark is always the template's own and every text comes
back unchanged. The loss mask is the span of each assistant turn's content, without marks and placeholders.

Turns are dealt by ranges of (conv_id, turn), so a conversation of any length is formatted by many tasks. It comes out
as segments: rows of whole turns, about ``SEGMENT_CHARS`` each, in the order (conv_id, lane, seq); their texts joined in
this order are the formatted conversation, spans count code points from the segment's start. ``read_back`` parses the
segments. A conversation that lies within one task is digested there, without another shuffle; the segments of one that
crosses tasks are passed on in order to one task, which keeps a running digest and a single segment, never the whole.

Defined results: null text counts as empty, null role as the empty role, a null or empty part list as no content; turns
go by (turn, role, content), null turns last, equal rows are turns of their own; rows of null conv_id are one
conversation; an empty table gives no rows; columns besides conv_id, turn, role, text and parts are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT_CHARS = 1 << 20
PATCH_PIXELS = 28                 # side of an image patch: one token each
AUDIO_TOKENS_PER_SECOND = 25
PAGE_TOKENS = 256                 # tokens of a document page
ASSISTANT = "assistant"

PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
SPAN = "struct<start: bigint, stop: bigint>"
ATTACHMENT = "struct<turn: int, kind: string, ref: string, at: bigint, n_tokens: bigint>"
SEGMENTS = (f"conv_id bigint, lane int, seq int, edge boolean, text string, n_turns int, loss array<{SPAN}>, "
            f"attachments array<{ATTACHMENT}>")
DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, "
          "n_attachments bigint, attachment_tokens bigint")

_TEXT_MARKS = re.compile(r"([\\#<])")
_ROLE_MARKS = re.compile(r"([\\#<:])")
_ESCAPED = re.compile(r"\\(.)", re.S)
_END = "</turn>\n"
_TURN = re.compile(r"### ((?:\\.|[^\\:]++)*+): ((?:\\.|[^\\#<]++|<(?!/turn>))*+)</turn>\n", re.S)
_PLACEHOLDER = re.compile(r"\\.|<[a-z]+ [0-9]+>", re.S)


def escape(text: str) -> str:
    return _TEXT_MARKS.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flatten:
    """Visitor over a turn's parts: ``out`` is the content, ``loss`` its trainable spans, ``attached`` its references."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.at = 0
        self.loss: list[tuple[int, int]] = []
        self.attached: list[tuple[str, str | None, int, int]] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type')}", self.visit_other)(part)

    def _write(self, s: str) -> None:
        self.out.append(s)
        self.at += len(s)

    def _attach(self, kind: str, part: dict, tokens: float) -> None:
        self.attached.append((kind, part.get("ref"), self.at, max(1, math.ceil(tokens))))
        self._write(f"<{kind} {len(self.attached)}>")

    def visit_text(self, part: dict) -> None:
        start = self.at
        self._write(escape(part.get("text") or ""))
        self.loss.append((start, self.at))

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil(max(part.get(k) or 0, 1) / PATCH_PIXELS) for k in ("width", "height"))
        self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        seconds = part.get("seconds") or 0.0
        self._attach("audio", part, AUDIO_TOKENS_PER_SECOND * seconds if math.isfinite(seconds) else 0)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, PAGE_TOKENS * max(part.get("pages") or 0, 1))

    def visit_other(self, part: dict) -> None:
        self._attach("other", part, 1)


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, list[tuple[int, int]], list[tuple]]:
    """(formatted turn, spans of its text parts, attachments (kind, ref, place, tokens)); places count from its start."""
    visitor = Flatten()
    for p in parts or []:
        visitor.visit(p or {})
    head = "### " + _ROLE_MARKS.sub(r"\\\1", role or "") + ": "
    n = len(head)
    return (head + "".join(visitor.out) + _END, [(a + n, b + n) for a, b in visitor.loss],
            [(k, r, at + n, t) for k, r, at, t in visitor.attached])


def parse_turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each formatted turn, unescaped and without its placeholders."""
    at = 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        yield unescape(m[1]), read_text(m[2])
        at = m.end()


def read_text(content: str) -> str:
    """A content's text: unescaped, placeholders left out."""
    return _PLACEHOLDER.sub(lambda m: m[0][1] if m[0][0] == "\\" else "", content)


def text_parts(text: Column) -> Column:
    """A plain text as the part list of one text part."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), null.cast("string").alias("ref"),
                            null.cast("int").alias("width"), null.cast("int").alias("height"), null.cast("double").alias("seconds"),
                            null.cast("int").alias("pages"))).cast(f"array<{PART}>")


def _spans(rows: list[list[tuple]], names: tuple[str, ...], types: tuple[pa.DataType, ...]) -> pa.Array:
    at = [0]
    for r in rows:
        at.append(at[-1] + len(r))
    flat = [x for r in rows for x in r]
    fields = [pa.array([x[k] for x in flat], t) for k, t in enumerate(types)]
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(fields, names=list(names)))


def _segments(batches: Iterator[pa.RecordBatch], plain: bool, limit: int) -> Iterator[pa.RecordBatch]:
    rows: list[list] = [[] for _ in range(8)]

    def batch() -> pa.RecordBatch:
        conv, lane, seq, edge, text, n, loss, att = rows
        big, small = pa.int64(), pa.int32()
        out = pa.RecordBatch.from_arrays(
            [pa.array(conv, big), pa.array(lane, small), pa.array(seq, small), pa.array(edge, pa.bool_()), pa.array(text, pa.string()),
             pa.array(n, small), _spans(loss, ("start", "stop"), (big, big)),
             _spans(att, ("turn", "kind", "ref", "at", "n_tokens"), (small, pa.string(), pa.string(), big, big))],
            ["conv_id", "lane", "seq", "edge", "text", "n_turns", "loss", "attachments"])
        for c in rows:
            c.clear()
        return out

    held = lane = conv = None
    seq, first, chars, buffered = 0, True, 0, 0

    def flush(edge: bool) -> None:
        nonlocal held, chars, seq, buffered
        text = "".join(held["text"])
        for column, value in zip(rows, (conv, lane, seq, edge, text, len(held["text"]), held["loss"], held["att"]), strict=True):
            column.append(value)
        buffered += len(text)
        held, chars, seq = None, 0, seq + 1

    for b in batches:
        convs, lanes, roles = (b.column(k).to_pylist() for k in ("conv_id", "lane", "role"))
        content = b.column("text" if plain else "parts").to_pylist()
        for c, ln, role, x in zip(convs, lanes, roles, content):
            if held is not None and c != conv:       # a conversation ended within this task; the first may have begun before it
                flush(first or seq > 0)
                first, seq = False, 0
            elif held is not None and chars >= limit:
                flush(True)
            conv, lane = c, ln
            text, spans, att = format_turn(role, [{"type": "text", "text": x}] if plain else x)
            if held is None:
                held = {"text": [], "loss": [], "att": []}
            if role == ASSISTANT:
                held["loss"] += [(a + chars, z + chars) for a, z in spans]
            held["att"] += [(len(held["text"]), k, r, a + chars, t) for k, r, a, t in att]
            held["text"].append(text)
            chars += len(text)
            if buffered >= limit:
                yield batch()
                buffered = 0
    if held is not None:
        flush(True)
    if rows[0]:
        yield batch()


def format_chat(df: DataFrame, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Segments of formatted conversations. ``df``: conv_id, turn, role and either ``parts`` (array of typed parts) or ``text``.

    ``edge`` marks segments of conversations that may go on in another segment."""
    plain = "parts" not in df.columns
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text") if plain else F.col("parts").cast(f"array<{PART}>").alias("parts")
    rows = df.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                     F.coalesce(F.col("role"), F.lit("")).alias("role"), body)
    rows = rows.withColumn("tie", F.xxhash64(F.col("text") if plain else F.to_json("parts")))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("role").asc(), F.col("tie").asc()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    laned = dealt.select("conv_id", F.spark_partition_id().alias("lane"), "role", "text" if plain else "parts")
    return laned.mapInArrow(lambda it: _segments(it, plain, segment_chars), SEGMENTS)


class Reader:
    """Running digest of one conversation's segments, fed in order."""

    def __init__(self) -> None:
        self.n = self.loss_chars = self.chars = self.attached = self.tokens = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, loss: list[dict], attachments: list[dict]) -> None:
        for role, said in parse_turns(text):
            self.n += 1
            self.turns.update(f"{role}\n{said}\n".encode())
        for s in loss:
            said = read_text(text[s["start"]:s["stop"]])
            self.loss_chars += len(said)
            self.loss.update(said.encode())
        self.chars += len(text)
        self.attached += len(attachments)
        self.tokens += sum(a["n_tokens"] for a in attachments)

    def result(self) -> tuple:
        return (self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.attached, self.tokens)


_CARRIED = SEGMENTS.replace("conv_id bigint", "conv_id bigint, done boolean") + ", digest struct<" + DIGEST.split(", ", 1)[1].replace(
    " bigint", ": bigint").replace(" string", ": string") + ">"
_DIGEST_NAMES = [f.split()[0] for f in DIGEST.split(", ")][1:]


def _digest_array(rows: list[tuple | None]) -> pa.Array:
    types = [pa.string() if "sha256" in n else pa.int64() for n in _DIGEST_NAMES]
    return pa.array([None if r is None else dict(zip(_DIGEST_NAMES, r, strict=True)) for r in rows],
                    pa.struct(list(zip(_DIGEST_NAMES, types, strict=True))))


def _read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the conversations whose one segment is all of them; other segments pass through."""
    for b in batches:
        edge = b.column("edge").to_pylist()
        digests: list[tuple | None] = [None] * len(edge)
        whole = [i for i, e in enumerate(edge) if not e]
        for i in whole:
            r = Reader()
            r.feed(b.column("text")[i].as_py(), b.column("loss")[i].as_py(), b.column("attachments")[i].as_py())
            digests[i] = r.result()
        done = pa.array([not e for e in edge], pa.bool_())
        names = [n for n in b.schema.names if n != "conv_id"]
        blank = [pa.array([None if d else v for d, v in zip(digests, b.column(n).to_pylist())], b.column(n).type)
                 if n in ("text", "loss", "attachments") else b.column(n) for n in names]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), done, *blank, _digest_array(digests)], ["conv_id", "done", *names, "digest"])


def _read_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of several segments, which come in order: one running digest at a time."""
    reader, conv = None, None
    for b in batches:
        ids, out = [], []
        for i, (c, done) in enumerate(zip(b.column("conv_id").to_pylist(), b.column("done").to_pylist())):
            if reader is not None and (done or c != conv):
                ids.append(conv)
                out.append(reader.result())
                reader = None
            if done:
                ids.append(c)
                out.append(tuple(b.column("digest")[i].as_py()[n] for n in _DIGEST_NAMES))
                continue
            if reader is None:
                reader, conv = Reader(), c
            reader.feed(b.column("text")[i].as_py(), b.column("loss")[i].as_py(), b.column("attachments")[i].as_py())
        if ids:
            yield _result(ids, out)
    if reader is not None:
        yield _result([conv], [reader.result()])


def _result(ids: list, rows: list[tuple]) -> pa.RecordBatch:
    d = _digest_array(rows)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[d.field(n) for n in _DIGEST_NAMES]], ["conv_id", *_DIGEST_NAMES])


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation, parsed from its segments: turns and their digest, loss text and its digest, length."""
    read = segments.mapInArrow(_read_whole, _CARRIED)
    together = read.repartition("conv_id").sortWithinPartitions("conv_id", "lane", "seq")
    return together.mapInArrow(_read_edges, DIGEST)
