"""Quality features, the weighted score, and the filter with its reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

#: Credibility of sources, .5 for all others.
CREDIBILITY = {"github": 0.9, "documentation": 1.0, "huggingface": 0.75, "blog": 0.65, "paper": 0.95}
#: Weights of the features, in the order in which they are added.
WEIGHTS = {
    "token_count": 0.10,
    "code_ratio": 0.15,
    "documentation_completeness": 0.15,
    "readability": 0.15,
    "duplicate_probability": 0.10,
    "source_credibility": 0.15,
    "example_density": 0.10,
    "instruction_density": 0.05,
    "broken_links": 0.05,
}
INSTRUCTION_MARKERS = r"(?iu)(?U)\b(you should|you can|steps?|first,|then,|note that|important:|example:|usage:)\b"
BROKEN_LINK = r"(?U)\]\(\s*\)|\]\(#\)|http[s]?://\s"
REASONS = ("duplicate", "below_min_token_count", "missing_quality_score", "below_quality_threshold", "below_readability_threshold")


def features(
    *, text: str = "text", token_count: str = "token_count", source: str = "source", n_blocks: Column | None = None, duplicate: Column | None = None,
    min_tokens: int = 30, target_tokens: int = 800,
) -> dict[str, Column]:
    """The nine features of a document, each rounded to 4 places."""
    t, tokens = F.col(text), F.col(token_count)
    blocks = F.size("code_blocks") if n_blocks is None else n_blocks
    prose = tx.strip_code_blocks(t)
    size = F.least(F.lit(1.0), tokens / float(target_tokens))
    parts = [t.rlike(r"(?md)(?U)^#{1,6}\s"), t.rlike(r"(?md)(?U)^[\-\*]\s|^\d+\.\s"), blocks > 0, F.length(prose) > 200]
    credit = F.lit(0.5)
    for name, value in CREDIBILITY.items():
        credit = F.when(F.col(source) == name, F.lit(value)).otherwise(credit)
    r4 = tx.round4
    return {
        "token_count": r4(F.when(tokens < min_tokens, size * 0.3).otherwise(size)),
        "code_ratio": r4(F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(tx.code_character_ratio(t) - 0.35) / 0.65)),
        "documentation_completeness": r4(sum(p.cast("int") for p in parts) / 4.0),
        "readability": tx.readability(t),
        "duplicate_probability": F.lit(1.0) if duplicate is None else F.when(duplicate, 0.0).otherwise(1.0),
        "source_credibility": credit,
        "example_density": r4(F.least(F.lit(1.0), blocks / 3.0)),
        "instruction_density": r4(F.least(F.lit(1.0), F.regexp_count(prose, F.lit(INSTRUCTION_MARKERS)) / 5.0)),
        "broken_links": r4(F.greatest(F.lit(0.0), F.lit(1.0) - F.regexp_count(t, F.lit(BROKEN_LINK)) * 0.2)),
    }


def score(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``quality_report`` (the features) and ``quality_score``."""
    out = tx.with_bound(docs, {"quality_report": F.struct(*[c.alias(n) for n, c in features(**options).items()])})
    total = F.lit(0.0)
    for name, weight in WEIGHTS.items():
        total = total + F.lit(weight) * F.col(f"quality_report.{name}")
    return tx.with_bound(out, {"quality_score": tx.round4(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))})


def rejection_reason(
    *, min_score: float = 0.55, min_tokens: int = 30, min_readability: float = 0.3, duplicate: Column | None = None,
    token_count: Column | str = "token_count", quality: Column | str = "quality_score", readability: Column | str = "quality_report.readability",
) -> Column:
    """The first reason that applies, null for a document to keep."""
    c = tx.col
    checks = [
        F.lit(False) if duplicate is None else duplicate,
        c(token_count) < min_tokens,
        c(quality).isNull(),
        c(quality) < min_score,
        F.coalesce(c(readability), F.lit(0.0)) < min_readability,
    ]
    out = F.lit(None).cast("string")
    for reason, check in reversed(list(zip(REASONS, checks, strict=True))):
        out = F.when(check, F.lit(reason)).otherwise(out)
    return out


def filter_report(marked: DataFrame) -> DataFrame:
    """One row: totals, removal rate, and counts by reason, of rows with ``reason``."""
    total, removed = F.count("*"), F.count("reason")
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    return marked.agg(
        total.alias("total"), (total - removed).alias("kept"), removed.alias("removed"),
        F.coalesce(tx.round4(removed / total), F.lit(0.0)).alias("removal_rate"), *counts,
    )


def latin_share(text: Column | str) -> Column:
    """Share of Latin letters among all letters; 1 without letters."""
    latin = F.regexp_count(tx.col(text), F.lit(r"\p{IsLatin}"))
    return F.coalesce(latin / F.nullif(F.regexp_count(tx.col(text), F.lit(r"\p{L}")), F.lit(0)), F.lit(1.0))


def is_english_script(text: Column | str, least: float = 0.9) -> Column:
    """Mostly plain A-Z letters: a script check, not language identification."""
    plain = F.regexp_count(tx.col(text), F.lit("[A-Za-z]"))
    return F.coalesce(plain / F.nullif(F.regexp_count(tx.col(text), F.lit(r"\p{L}")), F.lit(0)), F.lit(1.0)) >= least


def output_length_ok(output: Column | str, least: int = 50, most: int = 6000) -> Column:
    return F.length(tx.col(output)).between(least, most)


def domain_threshold_ok(quality: Column | str, category: Column | str, thresholds: dict[str, float], default: float = 0.55) -> Column:
    limit = F.lit(default)
    for name, value in thresholds.items():
        limit = F.when(tx.col(category) == name, F.lit(value)).otherwise(limit)
    return tx.col(quality) >= limit
