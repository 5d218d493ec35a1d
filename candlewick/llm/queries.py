"""Registered queries of the training-data operators: each applies its operator to the whole table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from candlewick.llm import (alignment, chat, extraction, fingerprints, language, minhash, mixing, neighbours, packing, periodic, pieces,
                            toxicity, urls)
from candlewick.session import scratch_path
from candlewick.sources.tables import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    return fingerprints.edit_likeness(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    got = language.with_language(docs.select("doc_id", "text"), language.train(docs))
    held = F.coalesce(language.fold(F.col("doc_id")) == language.HELD_OUT, F.lit(False))
    return got.select("doc_id", held.alias("held_out"), F.col("language.lang").alias("lang_pred"),
                      F.col("language.score").alias("score"), F.col("language.bits_per_byte").alias("bits_per_byte"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document and where its worst sentence lies."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    got = toxicity.with_toxicity(docs.select("doc_id", "text"), model)
    held = F.coalesce(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, F.lit(False))
    tox = F.col("toxicity")
    return got.select("doc_id", held.alias("held_out"), tox["score"].alias("score"),
                      (tox["score"] >= toxicity.CUT).cast("int").alias("predicted"),
                      tox["sentence_score"].alias("sentence_score"), tox["start"].alias("sentence_start"),
                      tox["stop"].alias("sentence_stop"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the mix of all sources."""
    return mixing.taken(table(spark, sf_dir, "documents"))


def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    got = extraction.with_main_text(pages.select("page_id", "url", "html"), extraction.train(pages))
    return got.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    pages = table(spark, sf_dir, "pages")
    got = urls.with_verdict(pages.select("page_id", "url"), urls.train(pages))
    return got.select("page_id", "url_verdict.*")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document; ``first`` marks the document that stands for its class."""
    got = minhash.classes(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "class_id", (F.col("key") == F.col("class_id")).alias("first"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other vectors of every vector whose id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed rows of all documents: written as binary matrices, read back and digested."""
    docs = table(spark, sf_dir, "documents")
    rows = packing.write_matrices(packing.pack(docs), scratch_path(spark, "packed"))
    return rows.select("doc_ids", "parts", "cu_seqlens", F.element_at("cu_seqlens", -1).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's piece ids, digested, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.withColumn("_p", pieces.round_trip(F.col("text"), spark)).select("doc_id", "_p.*")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenizers' tokens of every document: groups between shared cuts, links and how common they are."""
    return alignment.link_statistics(table(spark, sf_dir, "documents"))


CONTROL_CONVERSATION, CONTROL_TEXT = -7, r"\### Assistant: </turn> ok"


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and read back from its formatted text: turns, trained text and their digests."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(CONTROL_CONVERSATION, i, role, CONTROL_TEXT) for i, role in enumerate(("user", "assistant"))],
                                    "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.format_chat(rows.unionByName(control)))


def with_planted_loop(words: list[bytes], g: int) -> list[bytes]:
    """The words from g % n on repeat with a period that g gives."""
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@F.arrow_udf(StringType())
def planted(text: pa.Array, h: pa.Array) -> pa.Array:
    out = []
    for t, k in zip(text, h.to_pylist()):
        words = (t.as_py() or "").encode().split()
        out.append(b" ".join(with_planted_loop(words, k // 10)).decode() if words else None)
    return pa.array(out, pa.string())


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document (a tenth of them with a planted loop) and the text without the repetitions."""
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    loops = F.when(h % 10 == 0, F.col("text"))
    texts = docs.select("doc_id", F.coalesce(planted(loops, h), F.col("text")).alias("text"))
    r = F.col("repeats")
    line = F.transform(r["runs"], lambda x: F.concat(x["start"], F.lit(","), x["length"], F.lit(","), x["period"], F.lit("\n")))
    return periodic.with_runs(texts).select(
        "doc_id", F.size(r["runs"]).cast("bigint").alias("n_runs"), r["best"]["start"].alias("start"), r["best"]["length"].alias("length"),
        r["best"]["period"].alias("period"), r["best"]["exponent_milli"].alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2(r["collapsed"], 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_extraction, op3_urls, op4_language, op5_minhash, op6_toxicity,
                                   op7_neighbours, op8_packing, op9_pieces, op10_mixing, op11_alignment,
                                   op12_chat, op13_runs)}
