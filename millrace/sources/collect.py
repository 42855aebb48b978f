"""Collection: what a configuration's sources name, from a mirror of them, in one frame.

Fetching over a network is left to whatever keeps the mirror, a folder of this layout:

* ``github/<name>``: the repository's working tree;
* ``documentation/<name>.jsonl`` and ``blogs.jsonl``: pages as rows (url, body);
* ``huggingface/<repo_id with / as __>.jsonl``: rows with their number as ``row_index``;
* ``papers.jsonl``: rows (identifier, title, abstract, authors, body).

What the mirror lacks is passed over with a warning, as a failing source would be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import split
from ..plans.config import Sources
from ..plans.logs import get_logger
from ..plans.storage import hadoop_path
from . import files, html

log = get_logger("collect")

PAGE = "url string, body string"
PAPER = "identifier string, title string, abstract string, authors array<string>, body string"


def _mirrored(spark: SparkSession, path: str) -> bool:
    fs, where = hadoop_path(spark, path)
    if not fs.exists(where):
        log.warning("not in the mirror, passed over: %s", path)
        return False
    return True


def _in_order(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Rows whose ``column`` is one of ``names``, with its place in ``_place``."""
    at = F.array_position(F.array(*map(F.lit, names)), F.col(column)) if names else F.lit(0)
    return df.withColumn("_place", at.cast("long")).where("_place > 0")


def collect(spark: SparkSession, sources: Sources, mirror: str) -> DataFrame:
    """Documents of all sources with ``pos`` from 0: sources in their order, then files by path,
    pages and papers as the configuration lists them, rows by number."""
    parts: list[DataFrame] = []

    def add(docs: DataFrame, place: str) -> None:
        parts.append(docs.withColumn("_place_no", F.col(place).cast("string")).withColumn("_source_no", F.lit(len(parts))))

    for r in sources.github_repos:
        name = r.url.rstrip("/").split("/")[-1].removesuffix(".git")
        if _mirrored(spark, root := f"{mirror}/github/{name}"):
            docs = files.repository_files(
                spark, root, repo_url=r.url, include_paths=r.include_paths, category=r.category, framework=r.framework, max_file_size_kb=r.max_file_size_kb,
                source_suffixes=r.source_extensions if r.include_source else None,
            )
            add(docs, "file_path")
    numbered = lambda c: F.lpad(F.col(c).cast("string"), 19, "0")
    for d in sources.documentation:
        if _mirrored(spark, path := f"{mirror}/documentation/{d.name}.jsonl"):
            pages = _in_order(files.read_jsonl(spark, path, PAGE), "url", d.urls or [d.base_url])
            docs = html.page_documents(pages, body="body", format=d.format, category=d.category, framework=d.framework)
            places = pages.select(F.col("url").alias("_url"), numbered("_place").alias("_n"))
            add(docs.join(F.broadcast(places.distinct()), F.col("url") == F.col("_url")).drop("_url").withColumnRenamed("_n", "_order"), "_order")
    for h in sources.huggingface_datasets:
        if _mirrored(spark, path := f"{mirror}/huggingface/{h.repo_id.replace('/', '__')}.jsonl"):
            docs = files.dataset_rows(
                spark.read.json(path), repo_id=h.repo_id, index="row_index", text_column=h.text_field, split=h.split, category=h.category, max_examples=h.max_examples
            )
            add(docs.withColumn("_order", F.lpad(F.col("extra")["row_index"], 19, "0")), "_order")
    if sources.blogs and _mirrored(spark, path := f"{mirror}/blogs.jsonl"):
        pages = files.read_jsonl(spark, path, PAGE)
        for b in sources.blogs:
            add(html.page_documents(pages.where(F.col("url") == b.url), body="body", kind="blog", category=b.category, framework=b.framework, author=b.author), "url")
    if sources.papers and _mirrored(spark, path := f"{mirror}/papers.jsonl"):
        papers = files.read_jsonl(spark, path, PAPER)
        for p in sources.papers:
            add(files.paper_documents(papers.where(F.col("identifier") == p.identifier), category=p.category), "document_id")
    if not parts:
        return spark.createDataFrame([], files.DOCUMENT).withColumn("pos", F.lit(0).cast("long"))
    same = [F.col(f.name) for f in files.DOCUMENT.fields] + [F.col("_source_no"), F.col("_place_no")]
    frame = parts[0].select(*same)
    for part in parts[1:]:
        frame = frame.unionByName(part.select(*same))
    ranked = split.ranked(frame, ["_source_no", "_place_no", "document_id"], "pos")
    return ranked.withColumn("pos", F.col("pos") - 1).drop("_source_no", "_place_no")
