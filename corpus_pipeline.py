"""A corpus cleaned, deduplicated, redacted and packed, stage by stage.

Each stage is a function of (spark, docs, sf_dir) that calls one operator of
``millrace.llm``; all but the last return the columns of their input, whatever their
names. ``run`` writes each stage's result as Parquet to the shared folder and
reads it back for the next, so that a lost executor costs no more than the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import packing, quality, secrets, simhash, toxicity
from millrace.llm.common import drop_files_of, materialize, scratch, ship, spread


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go.

    A null or empty text is scored as one without words, and stays unless the labels
    make most texts toxic. Repeated rows share their fate; null ids are kept or go by
    their text alone. Very long texts are read whole. An empty table stays empty.
    """
    return toxicity.drop_toxic(docs, _labels(spark, sf_dir))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of poor quality, by text and site, go.

    A null or empty text counts as the labelled sample's share of good texts and its
    site; null sources or languages are a site of their own. Repeated rows share their
    fate. Very long texts are read whole. An empty table stays empty.
    """
    return quality.drop_poor(docs, _labels(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group whose five-word shingles are alike to 0.8 or more.

    It is that of the least id, then text hash; a null id comes last. Texts without words,
    null or not, are copies of each other; a text of one to four words is one shingle; of
    equal rows one stays. Very long texts are read whole. An empty table stays empty.
    """
    ship(spark)
    return simhash.keep_similar(docs, words=5, similarity=0.8)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials that are no widely copied examples are replaced by a mark.

    Every row stays; a null text stays null, an empty one empty, and ``n_chars`` follows
    the text. Null sources or languages are an owner or repository of their own. Repeated
    rows are redacted alike. Very long texts are read whole. An empty table stays empty.
    """
    ship(spark)
    return secrets.redact(docs, owner="source", repository="lang")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences of 1,024 ids: a row for each piece.

    A null or empty text gives the end id alone; repeated rows and null ids have pieces of
    their own; a very long text has many. An empty table gives an empty result.
    """
    ship(spark)
    return packing.piece_digests(packing.pack_documents(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: Classifiers, fingerprints and BPE have no SQL form; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result. What a stage has read or made on its way goes when its result is written."""
    docs, before = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")), None
    for name, stage in STAGES:
        with scratch(spark) as made:
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
            made.pop()  # the result itself, the last path that was made
        if before is not None:
            drop_files_of(before)
        before = docs
    return docs
