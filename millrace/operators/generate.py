"""Instruction examples from templates, with a cap for each document.

A template is a function from (chunk columns, context) to an array of structs, so all
templates of a chunk are one expression; examples are numbered by chunk, template and
place, and each document keeps its first valid ones.
"""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx

_EXAMPLE = "array<struct<instruction:string,input:string,output:string,difficulty:string,template:string>>"
#: Hints and keywords of the templates.
QUESTION_HINTS = ("how", "why", "what", "when", "should")
ARCHITECTURE = ("architecture", "design", "system", "workflow", "pipeline", "structure")
DEBUG = ("error", "exception", "fails", "issue", "bug", "troubleshoot", "fix", "raise ")
REASONING = ("because", "trade-off", "tradeoff", "advantage", "disadvantage", "however", "in contrast")
VERSUS = r"(?iu)(?U)\b([A-Z][\w\.\-]{1,30})\s+(?:vs\.?|versus|compared to)\s+([A-Z][\w\.\-]{1,30})"


#: What each template asks.
SENTENCES = {
    "qa": "What is {title} and how is it used in the context of {context}?",
    "instruction_following": "Explain {title} in the context of {context}, including key concepts and practical considerations.",
    "code_generation": "Write {language} code that demonstrates {title} ({context}).",
    "architecture_explanation": "Describe the architectural design and component interactions involved in {title}.",
    "debugging": "A developer working with {title} ({context}) is encountering issues. Explain likely causes and how to resolve them.",
    "reasoning": "What are the key trade-offs and reasoning behind design decisions related to {title}?",
    "comparison": "Compare {first} and {second} in the context of {context}, covering their key differences and appropriate use cases.",
}


def asked(template: str, chunk: Chunk, **more: Column) -> Column:
    """The template's sentence with the chunk's title and context, and ``more``, put in."""
    known = {"title": chunk.title, "context": chunk.context} | more
    parts = [x for before, name, *_ in Formatter().parse(SENTENCES[template]) for x in ([F.lit(before)] if before else []) + ([known[name]] if name else [])]
    return F.concat(*parts)


def _has(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(words))


def difficulty(tokens: Column) -> Column:
    return F.when(tokens < 150, "beginner").when(tokens < 500, "intermediate").otherwise("advanced")


class Chunk:
    """Columns that templates read. ``body`` is the text without fences, stripped."""

    def __init__(self) -> None:
        self.text, self.path, self.tokens = F.col("text"), F.col("heading_path"), F.col("token_count")
        self.body, self.blocks, self.lower = F.col("_body"), F.col("_blocks"), F.col("_lower")
        self.title = F.when(F.size(self.path) > 0, F.element_at(self.path, -1)).otherwise("this topic")
        self.context = F.when(F.coalesce(F.col("framework"), F.lit("")) != "", F.col("framework")).otherwise(F.col("category"))
        self.difficulty = difficulty(self.tokens)


def _one(when: Column, name: str, instruction: Column, output: Column, level: Column, given: Column | None = None) -> Column:
    example = F.struct(
        instruction.alias("instruction"), (F.lit("") if given is None else given).alias("input"), output.alias("output"),
        level.alias("difficulty"), F.lit(name).alias("template"),
    )
    return F.when(when, F.array(example)).otherwise(F.array().cast(_EXAMPLE))


def qa(c: Chunk) -> Column:
    own = F.when(c.title.endswith("?"), c.title).otherwise(F.concat(c.title, F.lit("?")))
    question = F.when(_has(F.lower(c.title), QUESTION_HINTS), own).otherwise(asked("qa", c))
    return _one((F.size(c.path) > 0) & (F.length(c.body) >= 40), "qa", question, c.body, c.difficulty)


def instruction_following(c: Chunk) -> Column:
    ask = asked("instruction_following", c)
    return _one(F.length(c.body) >= 60, "instruction_following", ask, c.body, c.difficulty)


def code_generation(c: Chunk) -> Column:
    given = F.when(c.body != "", F.concat(F.lit("Context: "), F.left(c.body, F.lit(400)))).otherwise("")
    fit = F.filter(c.blocks, lambda b: (F.length(b["code"]) >= 20) & ~b["language"].isin("text", ""))
    return F.transform(
        fit,
        lambda b: F.struct(
            asked("code_generation", c, language=b["language"]).alias("instruction"),
            given.alias("input"),
            F.concat(F.lit("```"), b["language"], F.lit("\n"), b["code"], F.lit("\n```")).alias("output"),
            c.difficulty.alias("difficulty"),
            F.lit("code_generation").alias("template"),
        ),
    ).cast(_EXAMPLE)


def architecture_explanation(c: Chunk) -> Column:
    both = F.lower(F.concat(c.text, F.array_join(c.path, " ")))
    ask = asked("architecture_explanation", c)
    return _one(_has(both, ARCHITECTURE) & (F.length(c.body) >= 80), "architecture_explanation", ask, c.body, F.lit("advanced"))


def debugging(c: Chunk) -> Column:
    ask = asked("debugging", c)
    return _one(_has(c.lower, DEBUG) & (F.length(c.body) >= 60), "debugging", ask, c.body, F.lit("advanced"))


def reasoning(c: Chunk) -> Column:
    ask = asked("reasoning", c)
    return _one(_has(c.lower, REASONING) & (F.length(c.body) >= 80), "reasoning", ask, c.body, F.lit("advanced"))


def comparison(c: Chunk) -> Column:
    a, b = (F.regexp_extract(c.text, VERSUS, k) for k in (1, 2))
    ask = asked("comparison", c, first=a, second=b)
    return _one(c.text.rlike(VERSUS) & (F.length(c.body) >= 60), "comparison", ask, c.body, F.lit("advanced"))


TEMPLATES: dict[str, Callable[[Chunk], Column]] = {
    f.__name__: f for f in (qa, instruction_following, code_generation, architecture_explanation, debugging, reasoning, comparison)
}


def register_template(name: str, build: Callable[[Chunk], Column]) -> None:
    """Add a template of one's own."""
    TEMPLATES[name] = build


def generate(chunks: DataFrame, documents: DataFrame, *, templates: list[str] | None = None, max_per_document: int = 3) -> DataFrame:
    """Examples of the chunks whose document is in ``documents``.

    chunks: document_id, chunk_id, chunk_index, text, token_count, heading_path;
    documents: document_id, source, category, framework, url, quality_score (no text).
    Names of unknown templates are passed over.
    """
    names = [t for t in (list(TEMPLATES) if templates is None else templates) if t in TEMPLATES]
    about = documents.select("document_id", "source", "category", "framework", "url", "quality_score")
    joined = chunks.join(about, "document_id").withColumns(
        {"_body": tx.strip(tx.strip_code_blocks("text")), "_blocks": tx.extract_code_blocks("text"), "_lower": F.lower("text")}
    )
    c = Chunk()

    def numbered(k: int, made: Column) -> Column:
        return F.transform(made, lambda e, i: F.struct(F.lit(k).alias("tpl"), i.alias("place"), e.alias("e")))

    made = F.flatten(F.array(*[numbered(k, TEMPLATES[n](c)) for k, n in enumerate(names)]))
    keep = ["document_id", "chunk_id", "chunk_index", "source", "category", "framework", "url", "quality_score"]
    # The generator gets the array as one item first, so that it is built once.
    rows = joined.select(*keep, F.explode(F.array(made)).alias("_made")).select(*keep, F.explode("_made").alias("m"))
    rows = rows.select(*keep, "m.tpl", "m.place", tx.strip("m.e.instruction").alias("instruction"), F.col("m.e.input").alias("input"), tx.strip("m.e.output").alias("output"), "m.e.difficulty", "m.e.template")
    rows = rows.where("instruction <> '' and output <> ''")
    first = Window.partitionBy("document_id").orderBy("chunk_index", "tpl", "place")
    capped = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= max_per_document)
    ident = tx.stable_hash(F.concat_ws(":", "chunk_id", "template", "instruction"), 16)
    metadata = F.struct("template", "document_id", "chunk_id", "framework", "url", "quality_score").alias("metadata")
    return capped.select(ident.alias("id"), "instruction", "input", "output", "category", "difficulty", "source", metadata, "chunk_index", F.col("_n").alias("example_index"))
