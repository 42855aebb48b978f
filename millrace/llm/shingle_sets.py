"""Sets of word shingles, and the exact check of their Jaccard similarity.

``simhash`` finds candidate pairs; here they are held to the similarity itself. First
come bounds that lose no pair: where the parities of two sets' counts in cells of the
hashes differ, so do the sets. The rest are checked by the size of the intersection. All
of it is joins on the set's hash, whose sides are aggregated to one row a set.

Defined results: a null text counts as empty, and sets without shingles are equal; a text
of fewer words than a shingle is one shingle; words are as for ``simhash.fingerprint``.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_files_of, materialize

SEED = 42
#: Cells of the two parity sketches, powers of two: the small one for all candidates,
#: the large one for those that it leaves, as sets of many shingles fill the small one.
CELLS, MORE_CELLS = 512, 4096
#: Up to so many candidate sets are broadcast to pick their shingles, else a shuffle join.
FEW_SETS = 200_000


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, dtype="<i8")
    if len(w) < words:
        w, words = [b" ".join(w)], 1
    shingles = map(b" ".join, zip(*(w[k : len(w) - words + 1 + k] for k in range(words)), strict=True))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8").view("<i8"))


def parity(s: np.ndarray, cells: int) -> list[int]:
    """For each cell of the hashes whether the set has an odd number there, as longs."""
    odd = np.bincount(s & (cells - 1), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def sets_of(pairs: DataFrame, marked: DataFrame, column: str) -> DataFrame:
    """``_fp`` and ``column`` of the sets in ``pairs``."""
    ids = pairs.select(F.col("a").alias("_fp")).union(pairs.select("b")).distinct()
    ids = F.broadcast(ids) if 2 * pairs.count() <= FEW_SETS else ids
    return materialize(marked.select("_fp", column).join(ids, "_fp", "left_semi").dropDuplicates(["_fp"]), "sets")


def may_link(pairs: DataFrame, sketch: DataFrame, column: str, like: Fraction) -> DataFrame:
    """Those of ``pairs`` that sizes and the parities in ``column`` do not rule out."""
    p, q = like.numerator, like.denominator
    a = sketch.select(F.col("_fp").alias("a"), F.col("_n").alias("na"), F.col(column).alias("pa"))
    b = sketch.select(F.col("_fp").alias("b"), F.col("_n").alias("nb"), F.col(column).alias("pb"))
    differ = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
    # Sets alike to p / q differ by at most (q - p) / (q + p) of their sizes' sum.
    may = (F.least("na", "nb") * q >= F.greatest("na", "nb") * p) & (differ * (q + p) <= (F.col("na") + F.col("nb")) * (q - p))
    return materialize(pairs.join(a, "a").join(b, "b").where(may).select("a", "b"), "pairs", narrow=True)


def checked(pairs: DataFrame, marked: DataFrame, sketch: DataFrame, like: Fraction) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose sets are alike enough."""
    p, q = like.numerator, like.denominator
    pairs = may_link(pairs.distinct(), sketch, "_parity", like)
    more = sets_of(pairs, marked, "_more_parity")
    pairs = may_link(pairs, more.join(sketch.select("_fp", "_n"), "_fp"), "_more_parity", like)
    drop_files_of(more)
    sets = sets_of(pairs, marked, "_shingles")
    x = sets.select(F.col("_fp").alias("a"), F.col("_shingles").alias("x"))
    y = sets.select(F.col("_fp").alias("b"), F.col("_shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    enough = both * (p + q) >= (F.size("x").cast("long") + F.size("y")) * p
    found = materialize(pairs.join(x, "a").join(y, "b").where(enough).select("a", "b"), "links", narrow=True)
    drop_files_of(sets)
    return found
