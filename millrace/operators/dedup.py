"""Exact and near duplicates, first come first kept.

Input order is part of the meaning, so every frame has ``pos``. Near duplicates are
those within a Hamming distance on 64-bit SimHash fingerprints, within one bucket of the
top 8 bits; a document is compared with the kept ones before it in its bucket.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..plans.storage import drop_files_of, materialize


_SIGNS = re.compile(r"[^\w\s]+")


def fingerprint(text: str | None) -> int:
    """Bitwise majority of the low md5 halves of a text's three-word shingles, repeats
    included; words are NFKC, lower case, without signs; 0 without words."""
    w = _SIGNS.sub("", unicodedata.normalize("NFKC", text or "").lower()).split()
    if not w:
        return 0
    grams = map(" ".join, zip(w, w[1:], w[2:], strict=False)) if len(w) > 2 else [" ".join(w)]
    low = b"".join([hashlib.md5(g.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()[8:] for g in grams])
    bits = np.unpackbits(np.frombuffer(low, dtype=np.uint8).reshape(-1, 8), axis=1)
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(bits)).view(">i8")[0])


def simhash(docs: DataFrame, *, text: str = "text", target: str = "simhash") -> DataFrame:
    """``docs`` with the fingerprint of each text. Nothing is shuffled: a text's votes are
    counted where it is read."""

    @F.pandas_udf("bigint")
    def prints(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(fingerprint).astype("int64")

    return docs.withColumn(target, prints(F.col(text).cast("string")))


def mark_exact(docs: DataFrame, *, content: str = "content_hash", pos: str = "pos") -> DataFrame:
    """``docs`` with ``is_exact_duplicate``: a content hash seen at an earlier position.

    The first position of each hash is a partial aggregate, so a hash that a third of
    the rows share does not gather them; an empty or null hash is never a duplicate.
    """
    first = docs.where(F.coalesce(F.col(content), F.lit("")) != "").groupBy(content).agg(F.min(pos).alias("_first"))
    joined = docs.join(first, content, "left")
    return joined.withColumn("is_exact_duplicate", F.coalesce(F.col(pos) > F.col("_first"), F.lit(False))).drop("_first")


def near_links(fps: DataFrame, max_distance: int) -> DataFrame:
    """Pairs (``early``, ``late``) of positions in one bucket within ``max_distance``.

    ``fps`` has distinct ``_fp`` and their first ``_pos``. The 56 bits below the bucket
    are dealt into m parts with thresholds of 1 or 0 that sum to ``max_distance - m + 1``:
    a pair is within the threshold in one part at least. A threshold of 1 takes a key for
    each bit of the part, without that bit. So an equi-join on (bucket, part), which Spark
    can spill and split, finds all pairs. It is a merge join by name: the planner takes the
    exploded keys for as few bytes as the fingerprints and would send them all to the driver.
    """
    parts = max_distance // 2 + 1
    ones, cuts = max_distance - parts + 1, [56 * k // parts for k in range(parts + 1)]
    keys = []
    for k in range(parts):
        mask = ((1 << cuts[k + 1]) - 1) ^ ((1 << cuts[k]) - 1) | 0xFF << 56
        for without in range(cuts[k], cuts[k + 1]) if k < ones else [None]:
            m = mask if without is None else mask ^ (1 << without)
            signed = m - (1 << 64) if m >> 63 else m
            keys.append(F.struct(F.lit(len(keys)).alias("part"), F.col("_fp").bitwiseAND(F.lit(signed)).alias("key")))
    each = fps.select("_fp", "_pos", F.explode(F.array(*keys)).alias("s")).select("_fp", "_pos", "s.*")
    a, b = each.alias("a"), each.alias("b")
    near = (F.col("a._pos") < F.col("b._pos")) & (tx.hamming_distance(F.col("a._fp"), F.col("b._fp")) <= max_distance)
    same = (F.col("a.part") == F.col("b.part")) & (F.col("a.key") == F.col("b.key"))
    return a.join(b.hint("merge"), same & near).select(F.col("a._pos").alias("early"), F.col("b._pos").alias("late")).distinct()


def greedy_dropped(links: DataFrame) -> DataFrame:
    """``_pos`` of what a pass in order drops for being linked to a kept one before it.

    In each round a position without an undecided or kept one before it is kept, and all
    that it links to later are dropped; rounds go on until none is undecided, which takes
    as many as the longest chain of near texts.
    """
    todo = materialize(links, "near-links", narrow=True)
    dropped = []
    while not todo.isEmpty():
        late = todo.select(F.col("late").alias("_pos")).distinct()
        kept = todo.select(F.col("early").alias("_pos")).distinct().join(late.hint("merge"), "_pos", "left_anti")
        gone = materialize(todo.join(kept.hint("merge"), todo["early"] == kept["_pos"]).select(F.col("late").alias("_pos")).distinct(), "near-dropped", narrow=True)
        dropped.append(gone)
        left = todo.join(gone.hint("merge"), todo["late"] == gone["_pos"], "left_anti")
        left = left.join(gone.hint("merge"), left["early"] == gone["_pos"], "left_anti")
        new = materialize(left, "near-links", narrow=True)
        drop_files_of(todo)
        todo = new
    if not dropped:
        return links.select(F.col("late").alias("_pos")).limit(0)
    return functools.reduce(DataFrame.union, dropped)


def mark_near(docs: DataFrame, *, fingerprint: str = "simhash", pos: str = "pos", threshold: float = 0.92) -> DataFrame:
    """``docs`` with ``is_near_duplicate`` and ``bucket_pos``, its bucket's first position.

    Equal fingerprints are collapsed to their first position first: a later copy of a
    kept text is near it, and one of a dropped text is near what that was dropped for.
    Tables with a row for each text are joined by merging, by name: their files of a few
    numbers a row are so small that the planner would send all rows to the driver.
    """
    max_distance = math.floor((1 - threshold) * 64 + 1e-9)
    firsts = materialize(docs.groupBy(F.col(fingerprint).alias("_fp")).agg(F.min(pos).alias("_pos")), "first-fingerprints", narrow=True)
    dropped = greedy_dropped(near_links(firsts, max_distance)).withColumn("_dropped", F.lit(True))
    kept_at = firsts.join(dropped.hint("merge"), "_pos", "left").select("_fp", F.when(F.col("_dropped"), -1).otherwise(F.col("_pos")).alias("_kept_pos"))
    bucket = F.shiftrightunsigned("_fp", 56)
    heads = firsts.groupBy(bucket.alias("_bucket")).agg(F.min("_pos").alias("bucket_pos"))
    joined = docs.join(kept_at.hint("merge"), F.col(fingerprint) == F.col("_fp")).withColumn("_bucket", bucket).join(F.broadcast(heads), "_bucket")  # 256 rows at most
    return joined.withColumn("is_near_duplicate", F.col(pos) != F.col("_kept_pos")).drop("_fp", "_kept_pos", "_bucket")


def deduplicate(docs: DataFrame, *, threshold: float = 0.92, pos: str = "pos", content: str = "content_hash", text: str = "text") -> DataFrame:
    """All rows with ``dedup_status`` (kept, exact, near) and ``bucket_pos``, which gives the order after it.

    Joins are merge joins by name, as in ``mark_near``.
    """
    exact = materialize(mark_exact(docs.select(pos, content), content=content, pos=pos).select(pos, "is_exact_duplicate"), "exact", narrow=True)
    left = docs.select(pos, text).join(exact.where("not is_exact_duplicate").hint("merge"), pos, "left_semi")
    prints = materialize(simhash(left, text=text).select(pos, "simhash"), "simhash")
    status = mark_near(prints, pos=pos, threshold=threshold)
    joined = docs.join(exact.hint("merge"), pos).join(status.hint("merge"), pos, "left")
    return joined.withColumn(
        "dedup_status", F.when(F.col("is_exact_duplicate"), "exact").when(F.col("is_near_duplicate"), "near").otherwise("kept")
    ).drop("is_exact_duplicate", "is_near_duplicate")
