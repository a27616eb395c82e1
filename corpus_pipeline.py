"""Corpus pipeline: a training corpus out of ``documents``, one training-data operator per stage.

Every stage works on all rows its predecessor kept, written as Parquet and read again. Toxicity, line dedup,
n-gram join and decontamination return the columns of ``documents`` (others pass through); the last stage
returns token ids and the text they decode to. Null texts stay null until then; rows without a doc_id are
kept by line dedup and the n-gram join, which compare documents, and judged on their own text by the other stages. Rows that repeat a doc_id are one document and stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import containment, line_runs, ngram_join, piece_codec, toxicity
from martwright.llm.ship import ship
from martwright.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; fitted on the labelled rows of this input that are not held out."""
    model = toxicity.train(ship(spark), docs, sf_dir)
    return toxicity.scored(docs, model).where("predicted = 0").select(docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that five documents share stay only in the last of them; ``n_chars`` follows the text."""
    cleaned = line_runs.clean(ship(spark), docs).withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept")))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast("long"))
    return cleaned.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the smallest doc_id stays."""
    found = ngram_join.near_copies(ship(spark), docs.select("doc_id", "text"))
    return docs.join(found.where("component_id <> doc_id").select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go; those without a doc_id are told by their text."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = containment.contained(ship(spark), docs, items).select("doc_id").distinct()
    by_text = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    nameless = docs.where("doc_id IS NULL").select(by_text.alias("doc_id"), "text")
    texts = containment.contained(spark, nameless, items).select(F.col("doc_id").alias("_mw_text")).distinct()
    left = docs.join(found, "doc_id", "left_anti").withColumn("_mw_text", by_text)
    return left.join(texts, "_mw_text", "left_anti").select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, text``: token ids of every document that is left, and the text they decode to."""
    ship(spark)
    model = piece_codec.default_model()
    return piece_codec.decode(piece_codec.encode(docs, model), model)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: Fitting a classifier and SentencePiece merges have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
