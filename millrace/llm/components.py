"""Connected components by alternating large-star and small-star rounds.

Every round is a partially aggregated ``min`` by node and a join on the node, both of
which Spark can spill and split; nothing is gathered on the driver but two sums that
tell whether the edges still change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_files_of, materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    # Edges point from the larger node u to the smaller node v.
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of an edge; root is the least node it reaches.

    ``edges`` has two long columns ``a`` and ``b``. Loops and rows with a null are
    ignored (a node with loops alone is not returned), repeated edges count once, and
    an empty input gives an empty result.
    """
    e = (
        edges.where(f"{a} <> {b}")
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    e = materialize(e, "edges", narrow=True)
    state = None
    while True:
        mark = e.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("s"),
        ).first()
        if state == mark or mark["n"] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root"))
            ).distinct()
        state = mark
        new = materialize(_small_star(_large_star(e).distinct()).distinct(), "edges", narrow=True)
        drop_files_of(e)
        e = new
