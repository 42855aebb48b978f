"""Centroid routing over embeddings, and its evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BROADCAST_DOMAINS = 10_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def centroids(vectors: DataFrame, *, domain: str = "label", vector: str = "embedding") -> DataFrame:
    """Element-wise mean vector of each domain; sums are partial before the exchange."""
    each = vectors.select(F.col(domain).alias("domain"), F.posexplode(vector).alias("i", "x"))
    means = each.groupBy("domain", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("domain").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centroid"))


def route(queries: DataFrame, centers: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", top_k: int = 2, cosine: bool = False) -> DataFrame:
    """The ``top_k`` domains of each query, with softmax weights over their scores.

    All centroids are one row's array (their number is checked), so each query is scored
    in place: no join of rows, and no shuffle of the queries.
    """
    if centers.count() > BROADCAST_DOMAINS:
        raise ValueError(f"routing holds at most {BROADCAST_DOMAINS} centroids")
    table = [(r["domain"], [float(x) for x in r["centroid"]]) for r in centers.orderBy("domain").collect()]
    kind = centers.schema["domain"].dataType
    literal = F.array(*[F.struct(F.lit(d).cast(kind).alias("domain"), F.array(*map(F.lit, c)).alias("centroid")) for d, c in table])
    q = F.col(vector)

    def score(c: Column) -> Column:
        raw = dot(q, c["centroid"])
        value = raw / (norm(q) * norm(c["centroid"]) + F.lit(1e-8)) if cosine else raw
        # Descending score, then the domain's order.
        return F.struct((-value).alias("neg"), c["domain"].alias("domain"))

    top = F.slice(F.array_sort(F.transform(literal, score)), 1, top_k)
    ranked = queries.select(F.col(id_col), F.explode(F.array(top)).alias("_top"))
    best = -F.element_at("_top", 1)["neg"]
    total = F.aggregate("_top", F.lit(0.0), lambda acc, t: acc + F.exp(-t["neg"] - best))
    rows = ranked.select(id_col, best.alias("_best"), total.alias("_total"), F.posexplode("_top").alias("rank", "t"))
    return rows.select(id_col, (F.col("rank") + 1).alias("rank"), F.col("t.domain").alias("domain"), (-F.col("t.neg")).alias("score"), (F.exp(-F.col("t.neg") - F.col("_best")) / F.col("_total")).alias("weight"))


def accuracy(routed: DataFrame, *, truth: str, guess: str) -> DataFrame:
    return routed.agg(F.count("*").alias("n"), F.avg((F.col(truth) == F.col(guess)).cast("int")).alias("accuracy"))


def confusion(routed: DataFrame, domains: list, *, truth: str, guess: str) -> DataFrame:
    """Counts of (truth, guess) in a fixed order of domains, zeros included."""
    spark = routed.sparkSession
    kind = routed.schema[truth].dataType
    rows = spark.createDataFrame([(d,) for d in domains], "d " + kind.simpleString())
    counts = routed.groupBy(truth).pivot(guess, domains).agg(F.count(F.lit(1)))
    return rows.join(counts, rows["d"] == counts[truth], "left").drop(truth).withColumnRenamed("d", truth).na.fill(0)


def row_mean(columns: list[str]) -> Column:
    """Mean of the columns that are not null; null if all are."""
    some = F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda x: x.isNotNull())
    return F.aggregate(some, F.lit(0.0), lambda acc, x: acc + x) / F.nullif(F.size(some), F.lit(0))


def mean_by_system(scores: DataFrame, systems: list[str], *, value: str = "avg_score") -> DataFrame:
    """Means in a fixed order of systems, null for those without scores."""
    order = scores.sparkSession.createDataFrame(list(enumerate(systems)), "pos int, system string")
    return order.join(scores.groupBy("system").agg(F.avg(value).alias(value)), "system", "left").select("pos", "system", value)


def mean_by_domain(scores: DataFrame, systems: list[str], *, value: str = "avg_score") -> DataFrame:
    return scores.groupBy("domain").pivot("system", systems).agg(F.avg(value))


def context_target_pairs(sentences: DataFrame, *, id_col: str, pos: str, vector: str, seed: int = 42) -> DataFrame:
    """For groups of 3 or more vectors: one picked by seeded hash, and the mean of the rest."""
    mine = sentences.select(F.col(id_col).alias("id"), F.col(pos).alias("p"), F.col(vector).alias("v"))
    pick = F.row_number().over(Window.partitionBy("id").orderBy(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string"), F.col("p").cast("string")), 256), "p"))
    n = F.count("*").over(Window.partitionBy("id"))
    marked = mine.withColumns({"target": pick == 1, "n": n}).where("n >= 3")
    rest = marked.where("not target").select("id", F.posexplode("v").alias("i", "x")).groupBy("id", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    context = rest.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("context"))
    return marked.where("target").select("id", F.col("p").alias("target_pos"), F.col("v").alias("target")).join(context, "id")
