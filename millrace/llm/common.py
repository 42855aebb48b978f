"""Helpers that several operators share: shared storage, let-bindings, running sums."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import storage
from ..plans.storage import drop_files_of, hadoop_path, materialize, new_path, scratch, shared_dir, spread

__all__ = ["drop_files_of", "fresh", "hadoop_path", "in_few_files", "in_few_parts", "let", "materialize", "new_path", "packed", "release", "running_sums", "scratch", "shared_dir", "ship", "spread"]

#: Most rows and bytes that go to a Python worker at once: texts may be very long.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, and bound what their Python workers hold."""
    storage.ship(spark)
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(f"spark.sql.execution.arrow.{key}").rstrip("bB"))
        if now <= 0 or now > most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that none of ``df`` clashes with, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while f"_{name}".lower() in taken:
        name += "_"
    return f"_{name}"


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one, so that no helper column can clash with any; ``name.*`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def in_few_parts(df: DataFrame) -> DataFrame:
    """``df`` in a few parts for each core: for narrow results, which give small files.

    The rows are dealt anew, which costs little as they are narrow; to coalesce would have
    the few tasks do all the work before.
    """
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def in_few_files(df: DataFrame) -> DataFrame:
    """``df`` in a part for each core, for tables that are written on the way.

    On a local file system without Hadoop's native library an executor forks to set the
    permissions of each file that it writes, and for a moment the child counts as large
    as the executor's JVM.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def release() -> None:
    """Give what a Python worker no longer uses back to the system, at the end of a task.

    Workers are kept for the next stages, and count towards their executor's memory.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, whatever the optimizer inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an array of longs.

    Works by blocks of about sqrt(n), so that n hits cost n*sqrt(n) copied items and
    not n*n.
    """

    def scan(arr: Column) -> Column:
        return F.aggregate(
            arr,
            F.array().cast("array<bigint>"),
            lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)),
        )

    def blocks(v: Column) -> Column:
        step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int"))
        last = F.greatest(F.lit(0), F.floor((F.size(v) - 1) / step).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda b: scan(F.slice(v, b * step + 1, step)))

    def join(parts: Column) -> Column:
        ends = scan(F.transform(parts, lambda p: F.coalesce(F.try_element_at(p, F.lit(-1)), F.lit(0).cast("bigint"))))
        return let(
            ends,
            lambda e: F.flatten(
                F.transform(parts, lambda p, i: F.transform(p, lambda x: x + F.when(i > 0, F.element_at(e, F.greatest(i, F.lit(1)))).otherwise(F.lit(0))))
            ),
        )

    return let(values.cast("array<bigint>"), lambda v: let(blocks(v), join))
