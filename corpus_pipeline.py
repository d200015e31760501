"""Corpus preparation as five stages over ``documents``; see STAGES."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import bpe, minhash, mixing, quality, toxicity
from terrace.llm.common import new_path
from terrace.llm.queries import QUALITY_LEAST, TOXIC_LEAST

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
SCORE = "__llm_score"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, does not reject."""
    model, _ = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_texts(docs, model, out=SCORE).where(F.col(SCORE) >= QUALITY_LEAST).drop(SCORE)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labelled ones among them, does not call toxic."""
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_texts(docs, lexicon, out=SCORE).where(F.col(SCORE) < TOXIC_LEAST).drop(SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return minhash.deduplicate(docs, minhash.Params(words=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at the target weights: each document as often as it is taken."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digests of the ids and of the bytes they decode to."""
    import public_tokenizers

    ranks, pattern = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN
    return bpe.digest(bpe.round_trip(docs.select("doc_id", "text"), ranks, pattern), keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_dedup", drop_copies),
    ("mix", mix_sources),
    ("byte_bpe", encode),
]

#: Classifiers and tokenizers are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are written as Parquet and read by the next."""
    folder = new_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
