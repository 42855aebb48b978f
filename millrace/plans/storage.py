"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}
_SHIPPED: set[str] = set()
_MADE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="millrace-")) / "millrace-modules.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Where neither is set, local mode (as in tests) gets a fresh temporary folder; a
    cluster's executors could not see that, so there it is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _OWN_DIR:
        _OWN_DIR[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return _OWN_DIR[context.applicationId]


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of ``path`` as Hadoop sees them."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file on whatever file system the path names."""
    fs, where = hadoop_path(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone at exit
        fs, where = hadoop_path(spark, path)
        fs.delete(where, True)


def new_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/millrace-{tag}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Paths that ``new_path`` gives within are removed at the end, but for those taken out of the list."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for path in made:
            remove(spark, path)


def materialize(df: DataFrame, tag: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage, and survives lost executors, since no block of it
    lives on an executor. ``narrow`` is for rows of a few numbers: partitions are
    written by no more tasks than a few for each core, for fewer and larger files.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    (df.coalesce(4 * spark.sparkContext.defaultParallelism) if narrow else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in a part for each core where it comes in fewer, as from one small file.

    Tables of many files have more parts than cores and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def drop_files_of(df: DataFrame) -> None:
    """Remove the files behind a frame that ``materialize`` returned."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)
