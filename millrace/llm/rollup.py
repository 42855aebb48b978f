"""Token counts in rollups that signed deltas maintain.

Totals by source, language and tokenizer version are additive, so a batch of changes is
one small table of signed sums: an insert adds its counts, a delete takes them away, and
a revision takes its old counts away and adds the new ones. A batch is written beside
the table and moved in under its id by one rename, so that it is there whole or not at
all, and a batch whose id is there already is skipped: a batch that is sent again, after
a lost answer or a lost driver, changes nothing. Of two writers that send one id at the
same time, the one whose token stands in the folder has won, whatever the rename said.

Totals are the sum over the batches. ``compact`` folds them into one: a fold holds the
sums and the ids of all batches that it stands for, and is published by one rename under
the next number. Readers take the fold with the highest number and leave out the batches
whose ids it holds, so that a driver may be lost at any step: before the rename nothing
has changed, after it nothing more is needed. What is left over is removed by the next
``compact``.

Change rows have ``before`` and ``after`` images (struct<source, lang, version, docs,
tokens, chars>); an insert has no before, a delete no after. Defined results: null keys
form groups of their own; null counts are zero; a row with neither image changes
nothing; an empty batch is committed and changes nothing; groups whose sums are all zero
are not reported; repeated rows count as often as they stand; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytebpe
from .common import hadoop_path, materialize, new_path

KEYS = ("source", "lang", "version")
SUMS = ("docs", "tokens", "chars")
_SCHEMA = ", ".join([*(f"{k} string" for k in KEYS), *(f"{s} bigint" for s in SUMS)])


def image(source, lang, version, tokens, chars) -> Column:
    """An image of one document for a change row."""
    return F.struct(
        F.col(source).alias("source"), F.col(lang).alias("lang"), F.lit(version).alias("version"), F.lit(1).cast("bigint").alias("docs"),
        F.col(tokens).cast("bigint").alias("tokens"), F.col(chars).cast("bigint").alias("chars"),
    )


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums of the changes, aggregated on each side of the shuffle."""
    signed = F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("i")), F.struct(F.lit(1).alias("sign"), F.col("after").alias("i")))
    rows = changes.select(F.explode(signed).alias("c")).where("c.i is not null")
    sums = [F.sum(F.col("c.sign") * F.coalesce(F.col(f"c.i.{s}"), F.lit(0))).cast("bigint").alias(s) for s in SUMS]
    return rows.groupBy(*[F.col(f"c.i.{k}").alias(k) for k in KEYS]).agg(*sums)


class TokenRollup:
    """A rollup table in a folder that all executors share. Any number may commit, one may compact."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.fs, self.root = hadoop_path(spark, self.path)
        self.fs.mkdirs(self.root)

    def _at(self, *names: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _rename(self, old: str, new: str) -> None:
        self.fs.rename(self._at(old), self._at(new))

    def _delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def _names(self) -> list[str]:
        """Names in the folder: what is there since the last compaction."""
        return [s.getPath().getName() for s in self.fs.listStatus(self.root)]

    @staticmethod
    def _live_fold(names: list[str]) -> str | None:
        return max((n for n in names if n.startswith("fold=")), key=lambda n: int(n[5:]), default=None)

    def _folded(self, fold: str | None) -> DataFrame:
        """``id``: the batches that a fold stands for."""
        if fold is None:
            return self.spark.createDataFrame([], "id string")
        return self.spark.read.schema("id string").json(f"{self.path}/{fold}/ids")

    def _state(self) -> tuple[str | None, list[str], list[str]]:
        """The live fold, the ids of batches beside it, and names that stand for nothing any more."""
        names = self._names()
        fold, ids = self._live_fold(names), [n[6:] for n in names if n.startswith("batch=")]
        in_fold = {r["id"] for r in self._folded(fold).where(F.col("id").isin(ids)).distinct().collect()} if fold and ids else set()
        gone = [n for n in names if n.startswith((".fold-", "fold=")) and n != fold] + [f"batch={i}" for i in ids if i in in_fold]
        return fold, sorted(i for i in ids if i not in in_fold), gone

    def batches(self) -> DataFrame:
        """``id`` of each committed batch."""
        fold, ids, _ = self._state()
        return self._folded(fold).union(self.spark.createDataFrame([(i,) for i in ids], "id string")).distinct()

    def committed(self, batch_id: str) -> bool:
        fold = self._live_fold(self._names())
        return self.fs.exists(self._at(f"batch={batch_id}")) or bool(self._folded(fold).where(F.col("id") == batch_id).head(1))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add the changes under ``batch_id``; False if that batch is there already."""
        if not batch_id.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"a batch id has letters, digits, - and _: {batch_id!r}")
        if self.committed(batch_id):
            return False
        staged, token = f".staged-{uuid.uuid4().hex}", f"_by-{uuid.uuid4().hex}"
        deltas(changes).write.parquet(f"{self.path}/{staged}")
        self.fs.create(self._at(staged, token), False).close()
        if not self.fs.exists(self._at(f"batch={batch_id}")):
            self._rename(staged, f"batch={batch_id}")
        if self.fs.exists(self._at(f"batch={batch_id}", token)):
            return True
        # Some file systems move the folder into the one that is there, where readers skip it.
        for lost in (staged, f"batch={batch_id}/{staged}"):
            self._delete(lost)
        return False

    def totals(self) -> DataFrame:
        """Current sums of each group that has any."""
        fold, ids, _ = self._state()
        parts = ([f"{self.path}/{fold}/sums"] if fold else []) + [f"{self.path}/batch={i}" for i in ids]
        rows = self.spark.read.schema(_SCHEMA).parquet(*parts) if parts else self.spark.createDataFrame([], _SCHEMA)
        sums = rows.groupBy(*KEYS).agg(*[F.sum(s).cast("bigint").alias(s) for s in SUMS])
        return sums.where(" or ".join(f"{s} <> 0" for s in SUMS))

    def compact(self) -> None:
        """Fold all batches into one table of sums."""
        fold, ids, gone = self._state()
        for name in gone:  # left over by a driver that was lost
            self._delete(name)
        if not ids:
            return
        staged = f".fold-{uuid.uuid4().hex}"
        self.totals().write.parquet(f"{self.path}/{staged}/sums")
        self._folded(fold).union(self.spark.createDataFrame([(i,) for i in ids], "id string")).write.json(f"{self.path}/{staged}/ids")
        self._rename(staged, f"fold={int(fold[5:]) + 1 if fold else 1}")
        for name in [*([fold] if fold else []), *(f"batch={i}" for i in ids)]:
            self._delete(name)


def with_token_counts(docs: DataFrame, *, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``docs`` with ``_bpe`` (byte-level BPE ids), ``_words`` and ``_chars`` of whole texts."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))

    @F.pandas_udf("bigint")
    def bpe(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = bytebpe.load(tokenizer)
        for some in texts:
            yield pd.Series(np.fromiter((len(encoder.ids(t)) for t in some), dtype=np.int64, count=len(some)))

    words = F.size(F.filter(F.split(body, r"[\x20\t-\r]+"), lambda w: w != ""))
    return docs.withColumns({"_bpe": bpe(body), "_words": words.cast("bigint"), "_chars": F.length(body).cast("bigint")})


def corpus_rollup(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", tokenizer: str | None = None) -> DataFrame:
    """Totals after a corpus' life: inserts, a new tokenizer version, deletes, and replays.

    Batch ``insert`` counts every document in words; batch ``revise`` moves every
    document to the byte-level BPE version; batch ``delete`` takes out all but one row
    of each text. Each batch is sent twice.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(source).alias("_source"), F.col(lang).alias("_lang"), F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    counted = with_token_counts(plain, text="_text", tokenizer=tokenizer).withColumn("_key", F.sha2(F.coalesce("_text", F.lit("")), 256)).drop("_text")
    counted = materialize(counted.withColumn("_row", F.monotonically_increasing_id()), "token-counts")
    words = image("_source", "_lang", "words-1", "_words", "_chars")
    bpe = image("_source", "_lang", "byte-bpe-50k", "_bpe", "_chars")
    none = F.lit(None)
    first = counted.groupBy("_key").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("f")).select(F.col("f._row").alias("_row"))
    copies = counted.join(first, "_row", "left_anti")
    rollup = TokenRollup(spark, new_path(spark, "rollup"))
    for _ in range(2):
        rollup.commit("insert", counted.select(none.cast(_image_type()).alias("before"), words.alias("after")))
        rollup.commit("revise", counted.select(words.alias("before"), bpe.alias("after")))
        rollup.commit("delete", copies.select(bpe.alias("before"), none.cast(_image_type()).alias("after")))
    return rollup.totals().select(*KEYS, *[F.col(s).alias(f"n_{s}") for s in SUMS])


def _image_type() -> str:
    return "struct<" + ",".join([*(f"{k}:string" for k in KEYS), *(f"{s}:bigint" for s in SUMS)]) + ">"
