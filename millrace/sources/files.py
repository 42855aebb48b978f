"""Documents from files: repositories' mirrors, JSON lines, row datasets, papers.

Fetching is left to whatever mirrors the sources to a file system; these readers scan it
with Spark's file sources, whose listing applies size and name filters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

#: Path parts and suffixes that are passed over, and documents' suffixes.
IGNORED_PARTS = (
    ".git", "node_modules", "build", "dist", "__pycache__", ".venv", "venv", "env", ".mypy_cache", ".pytest_cache", ".cache", "site-packages",
)
BINARY_SUFFIXES = (
    ".png", ".jpg", ".jpeg", ".gif", ".bmp", ".ico", ".svg", ".webp", ".pdf", ".zip", ".tar", ".gz", ".whl", ".so", ".dylib", ".dll",
    ".pyc", ".pyo", ".woff", ".woff2", ".ttf", ".eot", ".mp4", ".mp3", ".bin", ".exe", ".class", ".jar",
)
DOCUMENT_SUFFIXES = (".md", ".mdx", ".rst", ".ipynb", ".txt")
#: Fixed value: headings that open a paper's section.
SECTION = (
    r"(?imdu)(?U)^\s*(?:\d+\.?[^\S\n]+)?(abstract|introduction|related work|background|methodology|methods|approach|experiments?|"
    r"results|discussion|conclusion|references|acknowledge?ments?)\s*$"
)
#: The same, where the number of a heading may stand on a line before it.
SECTION_NUMBERED_ABOVE = SECTION.replace(r"[^\S\n]+", r"\s+")
SECTION_CHARS = 8000

DOCUMENT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("document_id", "text", "source", "repository", "author", "category", "framework", "url", "file_path", "programming_language", "version")]
    + [T.StructField("extra", T.MapType(T.StringType(), T.StringType()))]
)


def suffix(path: Column) -> Column:
    """The last suffix of a path, in lower case; names that begin with a point have none."""
    return F.lower(F.regexp_extract(path, r"[^/]+(\.[^./]*[^./])$", 1))


def is_ignored_path(path: Column | str) -> Column:
    p = tx.col(path)
    return F.arrays_overlap(F.split(p, "/"), F.array(*map(F.lit, IGNORED_PARTS))) | suffix(p).isin(*BINARY_SUFFIXES)


def decode_ignoring_errors(content: Column) -> Column:
    """UTF-8 text of bytes; bytes that are not UTF-8 are dropped."""

    @F.pandas_udf("string")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))

    return decoded(content)


def repository_web_url(url: Column, compat_rstrip: bool = False) -> Column:
    """The URL without .git; ``compat_rstrip`` drops any of the letters . g i t instead."""
    return F.regexp_replace(url, F.lit(r"[.git]+$" if compat_rstrip else r"\.git$"), F.lit(""))


def as_documents(df: DataFrame) -> DataFrame:
    """``df`` with all document columns, those that it lacks null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in DOCUMENT.fields])


def repository_files(
    spark: SparkSession, root: str, *, repo_url: str, include_paths: list[str], category: str = "uncategorized", framework: str | None = None,
    max_file_size_kb: int = 512, source_suffixes: list[str] | None = None, compat_rstrip: bool = False,
) -> DataFrame:
    """Documents of a repository's mirror at ``root``, ordered by relative path.

    Documentation comes from ``include_paths`` (files or folders); ``source_suffixes``
    adds source files of the whole mirror, wrapped in fences. Overlapping paths give a
    file once for each.
    """
    name = repo_url.rstrip("/").split("/")[-1].replace(".git", "")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    relative = F.regexp_replace(F.col("path"), F.lit("^.*?" + _quoted(base) + "/"), F.lit(""))
    small = files.where(F.col("length") <= max_file_size_kb * 1024).select(relative.alias("file_path"), "content").where(~is_ignored_path("file_path"))
    under = [F.when((F.col("file_path") == p) | F.col("file_path").startswith(p.rstrip("/") + "/"), F.lit(p)) for p in include_paths]
    docs = small.where(suffix(F.col("file_path")).isin(*DOCUMENT_SUFFIXES)).withColumn("_in", F.explode(F.filter(F.array(*under), lambda x: x.isNotNull()))).drop("_in")
    rows = docs.select("file_path", decode_ignoring_errors(F.col("content")).alias("text"), F.lit("github").alias("_space"), F.lit(None).cast("string").alias("programming_language"))
    rows = rows.where(tx.strip("text") != "")
    if source_suffixes:
        code = small.where(suffix(F.col("file_path")).isin(*source_suffixes)).select("file_path", decode_ignoring_errors(F.col("content")).alias("text"))
        tag = F.substring(suffix(F.col("file_path")), 2, 100)
        code = code.where(tx.strip("text") != "").select("file_path", F.concat(F.lit("```"), tag, F.lit("\n"), F.col("text"), F.lit("\n```")).alias("text"), F.lit("github_source").alias("_space"), tag.alias("programming_language"))
        rows = rows.unionByName(code)
    out = rows.select(
        tx.document_id(F.col("_space"), F.concat(F.lit(name + "/"), F.col("file_path"))).alias("document_id"), "text", F.lit("github").alias("source"),
        F.lit(repo_url).alias("repository"), F.lit(category).alias("category"), F.lit(framework).alias("framework"),
        F.concat(repository_web_url(F.lit(repo_url), compat_rstrip), F.lit("/blob/main/"), F.col("file_path")).alias("url"), "file_path", "programming_language",
    )
    return as_documents(out)


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def text_field(df: DataFrame, field: str) -> Column:
    """The field's value, or all non-blank string columns joined by blank lines."""
    if field in df.columns:
        return F.col(field).cast("string")
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    parts = F.filter(F.array(*[F.col(f"`{c}`") for c in strings]), lambda v: v.isNotNull() & (tx.strip(v) != "")) if strings else F.array().cast("array<string>")
    return F.when(F.size(parts) > 0, F.array_join(parts, "\n\n"))


def dataset_rows(df: DataFrame, *, repo_id: str, index: str, text_column: str = "text", split: str = "train", category: str = "uncategorized", max_examples: int | None = 2000) -> DataFrame:
    """Documents of a row dataset whose column ``index`` numbers its rows from 0.

    The limit counts rows before blank ones are dropped.
    """
    rows = df if max_examples is None else df.where(F.col(index) < max_examples)
    rows = rows.withColumn("_text", text_field(df.drop(index), text_column)).where(F.coalesce(tx.strip("_text"), F.lit("")) != "")
    number = F.col(index).cast("string")
    out = rows.select(
        tx.document_id(F.lit("huggingface"), F.concat(F.lit(repo_id + "_"), number)).alias("document_id"), F.col("_text").alias("text"), F.lit("huggingface").alias("source"),
        F.lit(repo_id).alias("repository"), F.lit(category).alias("category"), F.lit(f"https://huggingface.co/datasets/{repo_id}").alias("url"),
        F.lit(split).alias("version"), F.create_map(F.lit("row_index"), number).alias("extra"),
    )
    return as_documents(out)


def arxiv_id(identifier: Column | str) -> Column:
    return F.nullif(F.regexp_extract(tx.col(identifier), r"([0-9]{4}\.[0-9]{4,5})(v[0-9]+)?", 0), F.lit(""))


def segment_sections(body: Column | str, section_chars: int | None = SECTION_CHARS, numbered_above: bool = False) -> Column:
    """array<struct<heading, content>>: the last non-blank content of each heading, at the
    place of its first, cut to ``section_chars`` letters (None: whole).

    A number alone on the line before a heading is content, or lost as the heading's
    number with ``numbered_above``."""
    section = SECTION_NUMBERED_ABOVE if numbered_above else SECTION
    heads = F.transform(F.regexp_extract_all(tx.col(body), F.lit(section), F.lit(1)), lambda h: F.lower(tx.strip(h)))
    pieces = F.split(tx.col(body), section, -1)

    def cut(content: Column) -> Column:
        return content if section_chars is None else F.left(content, F.lit(section_chars))

    def build(s: Column) -> Column:
        pairs = F.transform(s["heads"], lambda h, i: F.struct(h.alias("heading"), cut(tx.strip(F.element_at(s["pieces"], i + 2))).alias("content")))
        full = F.filter(pairs, lambda p: p["content"] != "")
        names = F.array_distinct(F.transform(full, lambda p: p["heading"]))
        return F.transform(names, lambda n: F.element_at(F.filter(full, lambda p: p["heading"] == n), -1))

    return F.element_at(F.transform(F.array(F.struct(heads.alias("heads"), pieces.alias("pieces"))), build), 1)


def paper_documents(
    papers: DataFrame, *, category: str = "uncategorized", section_chars: int | None = SECTION_CHARS, numbered_above: bool = False
) -> DataFrame:
    """Documents of rows (identifier, title, abstract, authors, body); rows without an id
    or title are dropped."""
    rows = papers.withColumn("_id", arxiv_id("identifier")).where("_id is not null and title is not null")
    rows = rows.withColumn("_sections", F.coalesce(segment_sections("body", section_chars, numbered_above), F.array().cast("array<struct<heading:string,content:string>>")))
    parts = F.concat(F.lit("# "), F.col("title"), F.lit("\n\n## Abstract\n"), F.coalesce("abstract", F.lit("")))
    more = F.array_join(F.transform("_sections", lambda s: F.concat(F.lit("\n\n## "), F.initcap(s["heading"]), F.lit("\n"), s["content"])), "")
    out = rows.select(
        tx.document_id(F.lit("paper"), "_id").alias("document_id"), tx.normalize_whitespace(F.concat(parts, more)).alias("text"), F.lit("paper").alias("source"),
        F.nullif(F.array_join("authors", ", "), F.lit("")).alias("author"), F.lit(category).alias("category"), F.concat(F.lit("https://arxiv.org/abs/"), F.col("_id")).alias("url"),
        F.col("_id").alias("version"), F.create_map(F.lit("sections_found"), F.array_join(F.transform("_sections", lambda s: s["heading"]), ",")).alias("extra"),
    )
    return as_documents(out)


def atom_entries(xml: Column | str) -> list[Column]:
    """Title, abstract, authors and PDF link of an Atom response, read by XPath."""
    x = tx.col(xml)
    local = lambda n: f"*[local-name()='{n}']"
    entry = f"/{local('feed')}/{local('entry')}[1]"
    first = lambda path: F.nullif(tx.strip(F.call_function("xpath_string", x, F.lit(path))), F.lit(""))
    return [
        first(f"{entry}/{local('title')}").alias("title"),
        first(f"{entry}/{local('summary')}").alias("abstract"),
        F.transform(F.call_function("xpath", x, F.lit(f"{entry}/{local('author')}/{local('name')}/text()")), tx.strip).alias("authors"),
        first(f"{entry}/{local('link')}[@title='pdf'][1]/@href").alias("pdf_url"),
    ]


def pdf_text(content: Column) -> Column:
    """Text of PDF bytes, pages joined by line ends; null without pypdf or on failure."""

    @F.pandas_udf("string")
    def extracted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from io import BytesIO

        try:
            from pypdf import PdfReader
        except ImportError:
            PdfReader = None

        def one(raw):
            if raw is None or PdfReader is None:
                return None
            try:
                return "\n".join(page.extract_text() or "" for page in PdfReader(BytesIO(bytes(raw))).pages)
            except Exception:  # noqa: BLE001 - a broken file gives no text
                return None

        for part in parts:
            yield part.map(one)

    return extracted(content)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of JSON lines; blank lines are passed over, bad ones fail with their file."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """As ``read_jsonl``; a path that is not there gives no rows."""
    from ..plans.storage import hadoop_path

    fs, where = hadoop_path(spark, path)
    return read_jsonl(spark, path, schema) if fs.exists(where) else spark.createDataFrame([], schema)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", "true").json(path)


def list_files(spark: SparkSession, root: str, suffixes: list[str]) -> DataFrame:
    """Paths and sizes of the files with the suffixes, in order of path; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", "length").where(suffix(F.col("path")).isin(*suffixes)).orderBy("path")


def dir_size_mb(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.agg((F.sum("length") / (1024 * 1024)).alias("mb"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """UNION ALL in source order, with ``source_order`` for an explicit position."""
    out = None
    for k, frame in enumerate(frames):
        part = frame.withColumn("source_order", F.lit(k))
        out = part if out is None else out.unionByName(part)
    return out
