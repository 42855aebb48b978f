"""The statistics report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def average(value: Column | str) -> Column:
    """Mean of what is not null, rounded to 4 places, 0 of nothing."""
    return F.coalesce(tx.round4(F.avg(tx.col(value))), F.lit(0.0))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Counts of the values that are neither null nor empty."""
    return df.where(F.coalesce(F.col(column), F.lit("")) != "").groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def distributions(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(metric, value, n) of several columns in one scan: columns maps metric to column."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).alias("value")) for m, c in columns.items()])
    rows = df.select(F.explode(pairs).alias("p")).select("p.*")
    return rows.where(F.coalesce(F.col("value"), F.lit("")) != "").groupBy("metric", "value").agg(F.count("*").alias("n"))


def document_totals(filtered: DataFrame) -> DataFrame:
    """Averages of the documents that are left."""
    return filtered.agg(
        F.count("*").alias("documents_after_filtering"),
        average("token_count").alias("average_tokens_per_document"),
        average("quality_score").alias("average_quality_score"),
        average(tx.code_character_ratio("text")).alias("code_to_text_ratio"),
    )


def report(status: DataFrame, filtered: DataFrame, filter_row: dict, examples: DataFrame) -> dict:
    """The whole report as a dict: small aggregates, gathered on the driver."""
    spread = lambda df, cols: [r.asDict() for r in distributions(df, cols).collect()]
    docs = document_totals(filtered).first().asDict()
    docs |= status.agg(F.count("*").alias("documents_collected"), F.count_if(F.col("dedup_status") != "kept").alias("duplicates_removed")).first().asDict()
    by: dict[str, dict[str, int]] = {}
    wanted = {"category_distribution": "category", "framework_distribution": "framework", "source_distribution": "source", "language_distribution": "programming_language"}
    for row in spread(filtered, {m: c for m, c in wanted.items() if c in filtered.columns}):
        by.setdefault(row["metric"], {})[row["value"]] = row["n"]
    made = examples.withColumn("template", F.col("metadata.template")).agg(F.count("*").alias("total_examples"), average(F.length("output")).alias("average_output_length_chars")).first().asDict()
    inst: dict = {"difficulty_distribution": {}, "category_distribution": {}, "template_distribution": {}} | made
    for row in spread(examples.withColumn("template", F.col("metadata.template")), {"difficulty_distribution": "difficulty", "category_distribution": "category", "template_distribution": "template"}):
        inst[row["metric"]][row["value"]] = row["n"]
    return docs | {m: by.get(m, {}) for m in wanted} | {"filtering": filter_row, "instruction_dataset": inst}


def bar_charts(stats: dict, folder: str) -> list[str]:
    """Bar charts of the report's distributions, where matplotlib is there."""
    try:
        import matplotlib
    except ImportError:
        return []
    matplotlib.use("Agg")
    from matplotlib import pyplot as plt

    inst = stats["instruction_dataset"]
    charts = {
        "category_distribution": stats["category_distribution"], "difficulty_distribution": inst["difficulty_distribution"],
        "template_distribution": inst["template_distribution"], "source_distribution": stats["source_distribution"],
    }
    paths = []
    for name, counts in charts.items():
        if counts:
            fig, ax = plt.subplots()
            ax.bar(list(counts), list(counts.values()))
            ax.tick_params(axis="x", rotation=30)
            fig.savefig(f"{folder}/{name}.png")
            plt.close(fig)
            paths.append(f"{folder}/{name}.png")
    return paths
