"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Unit vectors x are stored as s*q + e with int8 q. For two of them,

    |x.y - s_x s_y q_x.q_y| <= |s_x q_x| |e_y| + |e_x| |y|,

so a tile product of int8 vectors and two numbers per vector bound each cosine from both
sides. Pairs whose upper bound misses the threshold are settled, as are those whose
lower bound reaches it; the rest is computed again in double precision. No pair is lost
and none below the threshold links.

Vectors are compared within one label and dimension. Equal vectors are collapsed first.
A label with n distinct vectors is dealt into ceil(n / tile) tiles by hash, of ``TILE``
vectors and ``TILE_BYTES`` at most, and each pair of tiles is a task of bounded size, so that a hot label spreads over the cluster. A
task returns one row per vector (its links there and its root in a spanning forest),
never the pairs. The number of tile pairs grows with the square of a label's distinct
vectors, as an exact search by this method must.

Defined results: vectors that are null, empty, zero, of null label, or that hold null or
non-finite components link with nothing (component_id = id, kept); an empty table gives
an empty result; repeated rows are separate vectors; null ids are passed through and are
never a component's id unless alone; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_few_parts, materialize
from .components import connected_components

#: Most vectors in a tile, and most bytes of them: long vectors get smaller tiles.
TILE, TILE_BYTES = 8192, 16 << 20
_ROWS = 1024
_SLACK = 4e-6  # above what float32 rounding adds to products of scales
_DIMS = 1024  # 127 * 127 * 1024 < 2**24: sums of int8 products stay exact in float32


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, norm of the scaled code, norm of the rest, for each row."""
    scale = np.abs(unit).max(axis=1) / 127
    scale[scale == 0] = 1
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    coded = q * scale[:, None]
    return q, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(unit - coded, axis=1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products of int8 rows."""
    out = np.zeros((len(a), len(b)), dtype=np.float32 if a.shape[1] <= _DIMS else np.float64)
    for at in range(0, a.shape[1], _DIMS):
        out += a[:, at : at + _DIMS].astype(np.float32) @ b[:, at : at + _DIMS].astype(np.float32).T
    return out


def _roots(n: int, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Least node that each of n nodes reaches by the links r-c."""
    lab = np.arange(n)
    while len(r):
        low = np.minimum(lab[r], lab[c])
        new = lab.copy()
        np.minimum.at(new, r, low)
        np.minimum.at(new, c, low)
        # Hook the old roots too, so that long chains shrink fast.
        np.minimum.at(new, lab[r], low)
        np.minimum.at(new, lab[c], low)
        new = new[new]
        if (new == lab).all():
            break
        lab = new
    return lab


def tile_links(x: np.ndarray, y: np.ndarray | None, wx: np.ndarray, wy: np.ndarray | None, threshold: float):
    """Links between the rows of x and y (None: within x).

    Returns the weighted link counts of x's rows and of y's, and the root of each row in
    a forest over x's rows followed by y's; with y None, counts for y are None.
    """
    inner = y is None
    if inner:
        y, wy = x, wx
    ux = x / np.linalg.norm(x, axis=1)[:, None]
    uy = y / np.linalg.norm(y, axis=1)[:, None]
    qx, sx, cx, ex = quantise(ux)
    qy, sy, cy, ey = quantise(uy)
    # |x.y - approx| <= cx*ey + ex*|y|; all in float32, covered by the slack.
    f = np.float32
    shift = 0 if inner else len(x)
    at_x, at_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    forest = []
    for at in range(0, len(x), _ROWS):
        rows = slice(at, at + _ROWS)
        approx = _products(qx[rows], qy) * sx[rows, None].astype(f) * sy[None, :].astype(f)
        err = cx[rows, None].astype(f) * ey[None, :].astype(f) + ex[rows, None].astype(f) + f(_SLACK)
        link = approx - err >= threshold
        r, c = np.nonzero((approx + err >= threshold) & ~link)
        for k in range(0, len(r), 1 << 17):
            rr, cc = r[k : k + (1 << 17)], c[k : k + (1 << 17)]
            dot = np.einsum("ij,ij->i", x[at + rr], y[cc])
            norm = np.sqrt(np.einsum("ij,ij->i", x[at + rr], x[at + rr]) * np.einsum("ij,ij->i", y[cc], y[cc]))
            ok = dot / norm >= threshold
            link[rr[ok], cc[ok]] = True
        if inner:
            n = len(link)
            link[np.arange(n), at + np.arange(n)] = False
        at_x[rows] = link @ wy
        if not inner:
            at_y += wx[rows] @ link
        r, c = np.nonzero(link)
        if len(r):
            lab = _roots(len(x) + (0 if inner else len(y)), r + at, c + shift)
            moved = np.nonzero(lab != np.arange(len(lab)))[0]
            forest.append((moved, lab[moved]))
    total = len(x) + (0 if inner else len(y))
    r = np.concatenate([f[0] for f in forest]) if forest else np.zeros(0, np.int64)
    c = np.concatenate([f[1] for f in forest]) if forest else np.zeros(0, np.int64)
    return at_x, None if inner else at_y, _roots(total, r, c)


def near_duplicate_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.98,
    tile: int = TILE,
) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links``, ``component_id``, ``kept``."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(label).alias("_label"), v.alias("_v"))
    fine = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("_v", lambda c: c != 0)
    rows = materialize(
        rows.withColumn("_ok", F.coalesce(F.col("_label").isNotNull() & fine, F.lit(False))).withColumn("_row", F.monotonically_increasing_id()),
        "vectors",
    )
    good = rows.where("_ok")
    # Copies are aggregated before the exchange, so that a large group of them is a row from each task.
    reps = materialize(
        good.groupBy("_label", "_v").agg(F.min("_row").alias("_rep"), F.count("*").alias("_n"), F.min("_id").alias("_least")).withColumn("_dim", F.size("_v")),
        "distinct-vectors",
    )
    fits = F.least(F.lit(tile), F.greatest(F.lit(1), F.floor(F.lit(TILE_BYTES) / (F.col("_dim") * 8))))
    tiles = reps.groupBy("_label", "_dim").agg(F.ceil(F.count("*") / fits).cast("int").alias("_tiles"))
    dealt = (
        reps.join(tiles, ["_label", "_dim"])
        .withColumn("_tile", F.pmod(F.xxhash64("_rep"), F.col("_tiles")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
        .select("_label", "_dim", F.least("_tile", "_other").alias("_i"), F.greatest("_tile", "_other").alias("_j"), "_tile", "_rep", "_n", "_v")
    )

    def task(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = key[-2], key[-1]
        first = pdf[pdf["_tile"] == i] if i != j else pdf
        second = pdf[pdf["_tile"] == j] if i != j else pdf.iloc[:0]
        out = {"_rep": [first["_rep"].to_numpy(), second["_rep"].to_numpy()]}
        if len(first) == 0 or (i != j and len(second) == 0):
            return pd.DataFrame({"_rep": pd.Series(dtype="int64"), "_links": pd.Series(dtype="int64"), "_root": pd.Series(dtype="int64")})
        x, wx = np.stack(first["_v"].to_numpy()), first["_n"].to_numpy()
        y, wy = (np.stack(second["_v"].to_numpy()), second["_n"].to_numpy()) if i != j else (None, None)
        # Lengths may be extreme: scale each vector by its largest component first.
        x = x / np.abs(x).max(axis=1)[:, None]
        y = None if y is None else y / np.abs(y).max(axis=1)[:, None]
        lx, ly, root = tile_links(x, y, wx, wy, threshold)
        rep = np.concatenate(out["_rep"])
        return pd.DataFrame({"_rep": rep, "_links": lx if ly is None else np.concatenate([lx, ly]), "_root": rep[root]})

    found = materialize(
        dealt.groupBy("_label", "_dim", "_i", "_j").applyInPandas(task, "_rep long, _links long, _root long"), "tile-links", narrow=True
    )
    counts = found.groupBy("_rep").agg(F.sum("_links").alias("_links"))
    parts = connected_components(found.where("_rep <> _root"), "_rep", "_root").select(F.col("node").alias("_rep"), F.col("root").alias("_root"))
    known = materialize(
        reps.select("_rep", "_n", "_least", "_label", "_v")
        .join(counts, "_rep", "left")
        .join(parts, "_rep", "left")
        .withColumn("_root", F.coalesce("_root", "_rep")),
        "vector-components",
    )
    ids = known.groupBy("_root").agg(F.min("_least").alias("_component"))
    settled = known.join(ids, "_root").select("_label", "_v", (F.col("_n") - 1 + F.coalesce("_links", F.lit(0))).alias("_links"), "_component")
    linked = good.join(settled, ["_label", "_v"]).select("_id", "_links", "_component")
    alone = rows.where("not _ok").select("_id", F.lit(0).cast("bigint").alias("_links"), F.col("_id").alias("_component"))
    return in_few_parts(linked.union(alone)).select(
        F.col("_id").alias(id_col),
        F.col("_links").alias("n_links"),
        F.col("_component").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_component")).alias("kept"),
    )
