"""Validation of instruction examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx

REQUIRED = ("id", "instruction", "output", "category", "difficulty", "source")
#: Fixed values.
CATEGORIES = (
    "agent_engineering", "llm_engineering", "retrieval_systems", "data_science", "ai_system_design",
    "technical_project_management", "uncategorized",
)
DIFFICULTIES = ("beginner", "intermediate", "advanced")


class ValidationError(ValueError):
    """An invalid example was met in strict mode."""


def validate(examples: DataFrame, *, pos: str = "pos", strict: bool = False) -> DataFrame:
    """``examples`` with ``issues``: array<struct<issue_type, detail>>, empty if valid.

    An id is a duplicate if an earlier valid example has it. The first valid position of
    an id is a partial aggregate joined back, so that a common id is not gathered.
    """
    issue = lambda kind, detail: F.struct(F.lit(kind).alias("issue_type"), detail.alias("detail"))
    checks = [(tx.is_blank(n), issue("missing_field", F.lit(n))) for n in REQUIRED]
    checks.append((tx.is_blank("output"), issue("empty_output", F.lit("output field is empty"))))
    late = [
        (~F.coalesce(F.col("category"), F.lit("")).isin(*CATEGORIES), issue("invalid_category", F.coalesce(F.col("category"), F.lit("")))),
        (~F.coalesce(F.col("difficulty"), F.lit("")).isin(*DIFFICULTIES), issue("invalid_difficulty", F.coalesce(F.col("difficulty"), F.lit("")))),
    ]
    found = lambda some: F.filter(F.array(*[F.when(c, i) for c, i in some]), lambda x: x.isNotNull())
    base = examples.withColumns({"_early": found(checks), "_late": found(late)})
    first = base.where((F.size("_early") == 0) & (F.size("_late") == 0)).groupBy("id").agg(F.min(pos).alias("_first"))
    again = F.when(F.col(pos) > F.col("_first"), F.array(issue("duplicate_id", F.lit("duplicate example id")))).otherwise(
        F.array().cast("array<struct<issue_type:string,detail:string>>")
    )
    out = base.join(first, "id", "left").withColumn("issues", F.concat("_early", again, "_late")).drop("_early", "_late", "_first")
    if strict and not (bad := out.where(F.size("issues") > 0)).isEmpty():
        row = bad.orderBy(pos).first()
        raise ValidationError(f"example {row['id']}: {[i['issue_type'] for i in row['issues']]}")
    return out


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("issues") == 0).drop("issues")


def issues_by_type(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("issues").alias("i")).groupBy("i.issue_type").agg(F.count("*").alias("n"))


def validation_report(checked: DataFrame) -> DataFrame:
    """One row: total, valid and invalid examples."""
    ok = F.count_if(F.size("issues") == 0)
    return checked.agg(F.count("*").alias("total_examples"), ok.alias("valid_examples"), (F.count("*") - ok).alias("invalid_examples"))
