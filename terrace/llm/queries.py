"""The registered queries: each applies one operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import (
    ann, bpe, embed_dedup, html_extract, minhash, mixing, pii, quality, resample, spelling, token_orc, toxicity, url_filter)
from terrace.llm.common import held_out, new_path
from terrace.llm.oracle import ORACLE  # noqa: F401
from terrace.llm.url_filter import Rule

URL_RULES = [Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
             Rule("net", "/es/", "block"), Rule("net", "/fr/", "block")]
QUALITY_LEAST, TOXIC_LEAST = 0.3, 0.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.duplicates(_table(spark, sf_dir, "documents"), minhash.Params(words=2, percent=80))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digest(bpe.round_trip(docs, ranks, public_tokenizers.PATTERN))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, min_hosts=2)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(_table(spark, sf_dir, "embeddings"), least=0.93)


def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "tokens")
    token_orc.write_tokens(_table(spark, sf_dir, "documents"), path,
                           public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_orc.digest(spark, path)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def _scored(rows: DataFrame, least: float) -> DataFrame:
    return rows.select("doc_id", held_out().alias("held_out"), "score",
                       (F.col("score") >= least).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    return _scored(toxicity.score_texts(docs, lexicon), TOXIC_LEAST)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model, stats = quality.train(docs, _table(spark, sf_dir, "labels"))
    return _scored(quality.score(stats, model), QUALITY_LEAST)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extract.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_minhash_dedup, op2_byte_bpe, op3_url_filter, op4_embedding_dedup, op5_token_orc, op6_mix_sources,
        op7_nearest, op8_toxicity, op9_quality, op10_html_extract, op11_resample,
        op12_spelling_variants, op13_pii)
}
