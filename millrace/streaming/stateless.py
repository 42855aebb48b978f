"""The stateless stages, exact deduplication and rollups over streams.

What depends on one document alone runs on a stream as it does on a table. Exact
deduplication keeps first sightings within a watermark; what needs all documents, such as
near-duplicates and the cap of examples, is left to batches (``by_batch``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import clean, code, score


def read_documents(spark: SparkSession, path: str, schema, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def prepare(docs: DataFrame, *, min_score: float = 0.55, min_tokens: int = 30, min_readability: float = 0.3) -> DataFrame:
    """Clean, enrich, extract, score, and name the reason to reject, per document."""
    rows = score.score(code.extract(clean.enrich(clean.clean(docs))))
    return rows.withColumn("reason", score.rejection_reason(min_score=min_score, min_tokens=min_tokens, min_readability=min_readability))


def first_sightings(docs: DataFrame, *, time: str, delay: str = "1 hour", text: str = "text") -> DataFrame:
    """Documents whose content was not seen within ``delay``."""
    hashed = docs.withColumn("content_hash", tx.stable_hash(text)).withWatermark(time, delay)
    return hashed.dropDuplicatesWithinWatermark(["content_hash"])


def windowed_counts(events: DataFrame, *, time: str = "ts", key: str = "event_type", value: str = "value", width: str = "10 minutes", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Counts and sums by tumbling or sliding window; late rows within ``delay`` count."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return events.withWatermark(time, delay).groupBy(window.alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n", "total"
    )


def session_counts(events: DataFrame, *, time: str = "ts", key: str = "user_id", gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Events of each session: a key's events with no gap as long as ``gap``."""
    return events.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("s"), key).agg(F.count("*").alias("n")).select(
        F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), key, "n"
    )


def by_batch(stream: DataFrame, apply: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Write ``apply`` of each micro-batch to its own folder: a batch sent again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        apply(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
