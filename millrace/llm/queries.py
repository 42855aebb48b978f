"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import embedding_dedup, imatch, language, oracles, packing, quality, rollup, secrets, sentencepiece_viterbi, simhash, toxicity
from .common import ship, spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For operators that spend long on each text: a small file is dealt to all cores."""
    return spread(_table(spark, sf_dir, "documents"))


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are the sources; a source's repositories are its languages' parts."""
    return secrets.secret_digests(_table(spark, sf_dir, "documents"), owner="source", repository="lang")


def op2_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op3_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op4_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.round_trips(_documents(spark, sf_dir))


def op5_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the sources; a host's paths are its languages' parts."""
    return quality.quality(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op6_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack_documents(_documents(spark, sf_dir)))


def op7_int8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op8_gph_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), radius=2, words=3)


def op9_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.corpus_rollup(_documents(spark, sf_dir))


def op10_cross_parse_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_ownership,
        op2_toxicity_chain,
        op3_imatch_fingerprints,
        op4_sentencepiece_viterbi,
        op5_quality_bayes,
        op6_sum_of_squares_packing,
        op7_int8_embedding_dedup,
        op8_gph_simhash,
        op9_token_rollup,
        op10_cross_parse_language,
    )
}

#: The other queries need BPE, XXH64, Viterbi paths or fitted models, which SQL has not;
#: tests hold them to brute force.
ORACLE: dict[str, str] = {"op1_secret_ownership": oracles.OP1, "op7_int8_embedding_dedup": oracles.OP7}
