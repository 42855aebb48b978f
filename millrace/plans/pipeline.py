"""The whole run: enrich, clean, deduplicate, extract, score, filter, chunk, generate,
validate, split, report, export.

Stages are lazy; the boundaries that are named in ``STAGES`` are written, so that a run
can be taken up again from any of them. Filtering comes before chunking, since a chunk
depends on its document alone: rejected documents are never chunked.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunk, clean, code, dedup, generate, score, split, stats, validate
from ..sources.collect import collect
from . import sinks
from .config import Chunking, Export, Generation, PipelineConfig, Quality
from .logs import get_logger
from .storage import hadoop_path, materialize, ship, write_text

log = get_logger("run")

#: The boundaries that a run writes.
STAGES = ("collect", "clean", "score", "filter", "chunk", "generate", "validate", "export")


@dataclass
class Settings:
    chunking: Chunking = field(default_factory=Chunking)
    quality: Quality = field(default_factory=Quality)
    generation: Generation = field(default_factory=Generation)
    export: Export = field(default_factory=Export)
    tokenizer: str | None = None  # a rank file or an encoding's name; None: the default rule

    @classmethod
    def of(cls, config: PipelineConfig) -> Settings:
        """The settings that a configuration holds."""
        return cls(config.chunking, config.quality, config.instruction_generation, config.export, config.tokenizer.get("encoding_name"))


def cleaned(docs: DataFrame, settings: Settings) -> DataFrame:
    """All documents that are not blank when clean, with ``dedup_status``."""
    rows = materialize(clean.enrich(clean.clean(docs), tokenizer=settings.tokenizer), "cleaned")
    return dedup.deduplicate(rows, threshold=settings.quality.max_duplicate_similarity)


def scored(status: DataFrame) -> DataFrame:
    """The kept documents with code blocks, features and score."""
    rows = code.extract(status.where("dedup_status = 'kept'"))
    return score.score(rows)


def marked(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rows`` with the ``reason`` to reject them, null for none."""
    q = settings.quality
    return rows.withColumn(
        "reason", score.rejection_reason(min_score=q.min_quality_score, min_tokens=q.min_token_count, min_readability=q.min_readability_score)
    )


def chunked(docs: DataFrame, settings: Settings) -> DataFrame:
    c = settings.chunking
    return chunk.chunk(docs, chunk.ChunkConfig(c.chunk_size_tokens, c.chunk_overlap_tokens, c.min_chunk_tokens, c.max_chunk_tokens, c.respect_code_blocks, settings.tokenizer))


def generated(chunks: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Examples with ``pos``: documents in their order after deduplication."""
    g = settings.generation
    rows = generate.generate(chunks, docs, templates=g.templates, max_per_document=g.max_examples_per_document)
    place = docs.select(F.col("document_id").alias("_d"), F.col("bucket_pos"), F.col("pos").alias("_p"))
    joined = rows.join(place, F.col("metadata.document_id") == F.col("_d"))
    return split.ranked(joined, ["bucket_pos", "_p", "example_index"], "pos").drop("_d", "bucket_pos", "_p", "chunk_index", "example_index")


def run(spark: SparkSession, docs: DataFrame, out: str, settings: Settings | None = None) -> dict:
    """Run all stages over ``docs`` (document columns and ``pos``) into folder ``out``.

    Returns the statistics. Boundaries are Parquet; the filter's, the validation's and the
    statistics report are JSON files in ``reports``, with bar charts where they can be drawn.
    """
    settings = settings or Settings()
    ship(spark)

    def bound(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        log.info("wrote %s", name)
        return spark.read.parquet(f"{out}/{name}")

    raw = bound(docs, "collect")
    status = bound(cleaned(raw, settings), "clean")
    checked = bound(marked(scored(status), settings), "score")
    kept = bound(checked.where("reason is null"), "filter")
    chunks = bound(chunked(kept, settings), "chunk")
    examples = bound(generated(chunks, kept, settings), "generate")
    verdict = bound(validate.validate(examples), "validate")
    good = validate.valid(verdict)
    exported(good, out, settings)
    filter_row = score.filter_report(checked).first().asDict()
    checks = validate.validation_report(verdict).first().asDict() | {"issues_by_type": {r["issue_type"]: r["n"] for r in validate.issues_by_type(verdict).collect()}}
    result = stats.report(status, kept, filter_row, good)
    for name, report in (("filter_report", filter_row), ("validation_report", checks), ("dataset_statistics", result)):
        write_text(spark, f"{out}/reports/{name}.json", sinks.as_json(report))
    with tempfile.TemporaryDirectory() as here:  # on the driver, which moves them to the reports
        for chart in stats.bar_charts(result, here):
            fs, where = hadoop_path(spark, f"{out}/reports/{Path(chart).name}")
            fs.copyFromLocalFile(True, True, hadoop_path(spark, f"file://{chart}")[1], where)
    return result | {"validation": checks}


def exported(good: DataFrame, out: str, settings: Settings) -> list[str]:
    """The valid examples, split and written in each format; the paths written."""
    parts = split.train_validation(good.drop("pos"), train_split=settings.export.train_split, seed=settings.export.shuffle_seed)
    return sinks.export(parts, f"{out}/export", settings.export.dataset_name, list(settings.export.formats))


def run_config(spark: SparkSession, config: PipelineConfig, mirror: str, out: str) -> dict:
    """Collect what a configuration names from its mirror, and run all stages over it."""
    ship(spark)
    return run(spark, collect(spark, config.sources, mirror), out, Settings.of(config))


def run_stage(spark: SparkSession, name: str, out: str, settings: Settings | None = None, *, config: PipelineConfig | None = None, mirror: str | None = None) -> DataFrame:
    """Run one stage again from the boundary before it, and write its own.

    ``collect`` needs the configuration and its mirror; ``export`` writes its files and
    returns the valid examples.
    """
    settings = settings or (Settings.of(config) if config else Settings())
    ship(spark)
    at = lambda stage: spark.read.parquet(f"{out}/{stage}")
    if name == "export":
        good = validate.valid(at("validate"))
        exported(good, out, settings)
        return good
    if name == "collect" and (config is None or mirror is None):
        raise ValueError("collect needs a configuration and the mirror of its sources")
    build = {
        "collect": lambda: collect(spark, config.sources, mirror),
        "clean": lambda: cleaned(at("collect"), settings),
        "score": lambda: marked(scored(at("clean")), settings),
        "filter": lambda: at("score").where("reason is null"),
        "chunk": lambda: chunked(at("filter"), settings),
        "generate": lambda: generated(at("chunk"), at("filter"), settings),
        "validate": lambda: validate.validate(at("generate")),
    }
    if name not in build:
        raise ValueError(f"no such stage: {name}; one of {sorted([*build, 'export'])}")
    build[name]().write.mode("overwrite").parquet(f"{out}/{name}")
    return at(name)
