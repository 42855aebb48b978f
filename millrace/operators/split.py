"""Sampling, caps and the train/validation split."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.storage import materialize


def ranked(df: DataFrame, order: list, target: str) -> DataFrame:
    """``df`` with its row number from 1 in ``order``, without one task seeing all rows.

    Rows are range-partitioned and numbered within their partition; the counts of the
    partitions, as many rows as there are partitions, give the offsets.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = materialize(sorted_.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part, inner = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = marked.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    joined = marked.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn(target, inner + F.col("_before") + 1).drop("_part", "_at", "_before")


def train_validation(df: DataFrame, *, id_col: str = "id", train_split: float = 0.9, seed: int = 42) -> DataFrame:
    """``df`` with ``split``: exactly floor(n * train_split) rows are train, by seeded hash."""
    key = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")), 256)
    out = ranked(df.withColumn("_key", key), ["_key", id_col], "_rank")
    n = df.count()
    return out.withColumn("split", F.when(F.col("_rank") <= int(n * train_split), "train").otherwise("validation")).drop("_key", "_rank")


def shuffled_positions(n: int, seed: int = 42) -> list[int]:
    """The order that a seeded in-memory shuffle of n rows gives: for exact membership."""
    order = list(range(n))
    random.Random(seed).shuffle(order)
    return order


def train_validation_exact(df: DataFrame, *, pos: str = "pos", train_split: float = 0.9, seed: int = 42) -> DataFrame:
    """As a seeded in-memory shuffle splits the rows in order of ``pos`` (0 to n - 1).

    The permutation is made on the driver, so this is for tables of at most some million
    rows; ``train_validation`` has no such bound.
    """
    n = df.count()
    order = shuffled_positions(n, seed)
    train = df.sparkSession.createDataFrame([(p,) for p in order[: int(n * train_split)]], "_p long").withColumn("_train", F.lit(True))
    return df.join(train, F.col(pos) == F.col("_p"), "left").withColumn("split", F.when(F.col("_train"), "train").otherwise("validation")).drop("_p", "_train")


def cap_per_group(df: DataFrame, group: str, caps: dict[str, int], order: list) -> DataFrame:
    """The first rows of the groups that have a cap; all rows of the others.

    Each cap is a top-k, which every task applies to its own rows first, so that a hot
    group is never gathered.
    """
    out = df.where(~F.coalesce(F.col(group).isin(*caps), F.lit(False)))
    for name, cap in caps.items():
        out = out.unionByName(df.where(F.col(group) == name).orderBy(*order).limit(cap))
    return out


def head(df: DataFrame, n: int, order: list) -> DataFrame:
    return df.orderBy(*order).limit(n)
