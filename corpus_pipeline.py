"""Corpus pipeline over ``documents``: toxicity, language, near-duplicates, mixing, sub-word encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import language, minhash, mixing, pieces, toxicity
from candlewick.session import scratch_path
from candlewick.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the cut."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _columns(toxicity.with_toxicity(docs, model, out="_tox").where(F.col("_tox.score") < toxicity.CUT))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written in a learned language: not ``und``, and fewer bits a byte than the byte itself has."""
    got = language.with_language(docs, language.train(docs), out="_lang")
    return _columns(got.where((F.col("_lang.lang") != "und") & (F.col("_lang.bits_per_byte") < 8)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return _columns(minhash.one_per_class(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target mix takes it."""
    return _columns(mixing.mixed(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix."""
    return pieces.encode(_columns(docs)).select("doc_id", "lang", "source", "ids", F.size("ids").alias("n_tokens"))


STAGES = [("toxicity", drop_toxic), ("language", keep_languages), ("near-duplicates", drop_near_duplicates),
          ("mixing", mix_sources), ("pieces", encode_pieces)]

ORACLE_SQL = None      # trained models and sub-word encoding: no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
