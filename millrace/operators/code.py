"""Fenced code with language, context and line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

CONTEXT_CHARS = 300

#: What marks a language, in the order in which they are tried.
LANGUAGE_MARKS = (
    ("python", r"(?md)(?U)^\s*(def |class |import |from .+ import)"),
    ("javascript", r"(?md)(?U)^\s*(function |const |let |var |=>)"),
    ("typescript", r"(?md)(?U)^\s*(interface |type \w+ =|export )"),
    ("sql", r"(?imd)(?U)^\s*(SELECT|INSERT|UPDATE|DELETE)\s"),
    ("json", r"(?U)\A\s*\{"),
    ("dockerfile", r"(?md)(?U)^\s*(FROM|RUN|CMD|COPY)\s"),
    ("yaml", r"(?md)(?U)^\s*apiVersion:|^\s*kind:"),
)


def guess_language(code: Column) -> Column:
    out = F.lit("text")
    for language, mark in reversed(LANGUAGE_MARKS):
        out = F.when(code.rlike(mark), F.lit(language)).otherwise(out)
    return out


def code_blocks(text: Column | str) -> Column:
    """array<struct<language, code, surrounding_context, line_start>> of non-empty fences.

    The texts between the fences, whose lengths are summed from left to right, give the
    places. A text has few fences, so sums over slices of them are cheap.
    """
    raw = tx.col(text)
    hits = F.regexp_extract_all(raw, F.lit(tx.FENCE), F.lit(0))
    tags = F.regexp_extract_all(raw, F.lit(tx.FENCE), F.lit(1))
    codes = F.regexp_extract_all(raw, F.lit(tx.FENCE), F.lit(2))
    gaps = F.split(raw, tx.FENCE, -1)

    def build(s: Column) -> Column:
        def block(tag: Column, i: Column) -> Column:
            code = tx.strip(F.element_at(s["codes"], i + 1))
            before = F.aggregate(F.slice(s["gaps"], F.lit(1), i + 1), F.lit(0), lambda acc, g: acc + F.length(g))
            start = before + F.aggregate(F.slice(s["hits"], F.lit(1), i), F.lit(0), lambda acc, h: acc + F.length(h))
            near = F.substring(s["text"], F.greatest(F.lit(1), start - CONTEXT_CHARS + 1), F.least(F.lit(CONTEXT_CHARS), start))
            lines = F.length(F.substring(s["text"], F.lit(1), start)) - F.length(F.replace(F.substring(s["text"], F.lit(1), start), F.lit("\n"), F.lit("")))
            return F.struct(
                F.when(tag == "", guess_language(code)).otherwise(F.lower(tag)).alias("language"),
                code.alias("code"),
                tx.strip(near).alias("surrounding_context"),
                (lines + 1).cast("int").alias("line_start"),
            )

        return F.filter(F.transform(s["tags"], block), lambda b: b["code"] != "")

    bound = F.struct(hits.alias("hits"), tags.alias("tags"), codes.alias("codes"), gaps.alias("gaps"), raw.alias("text"))
    return F.element_at(F.transform(F.array(bound), build), 1)


def dominant_language(blocks: Column) -> Column:
    """The commonest language, the first seen of ties; null without blocks."""
    languages = F.transform(blocks, lambda b: b["language"])
    # Sorting by (count, -first place) puts the answer last.
    ranked = F.transform(F.array_distinct(languages), lambda x, i: F.struct(F.size(F.filter(languages, lambda y: y == x)).alias("n"), (-i).alias("first"), x.alias("language")))
    return F.array_max(ranked)["language"]


def extract(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with ``code_blocks`` and, where it was null, ``programming_language``."""
    out = tx.with_bound(docs, {"code_blocks": code_blocks(text)})
    known = F.col("programming_language") if "programming_language" in docs.columns else F.lit(None).cast("string")
    return out.withColumn("programming_language", F.coalesce(known, dominant_language(F.col("code_blocks"))))
