"""Toxicity by a classifier chain.

Categories are predicted one after the other; each linear model sees the words of the
text and the probabilities that the models before it gave. The probabilities to train on
are out of fold: those of models that did not see the document, so that a later model
learns to trust an earlier one no more than it deserves.

The categories are the label columns, last the one that decides. Where a corpus has just
that one label, the chain begins with ``KINDS`` categories that are found in the labelled
texts themselves: the toxic ones are grouped by the telling words that they share
(spherical k-means from far-apart seeds), whatever their language, and to belong to a
group is a category.

Models are logistic with an L1 penalty over the presence of words and word beginnings
(which inflected forms share), as the labels select them: the ``FEATURES`` terms in
``LEAST_TEXTS`` or more texts whose share of positives is furthest, by ``LEAST_Z`` or more
standard errors, from that of all. Training uses a bounded sample of labelled documents
(``SAMPLE_DOCS`` whole texts of together ``SAMPLE_LETTERS`` at most, by the hash of the
text). Scoring reads whole texts, in one pass without a shuffle.

Defined results: a null or empty text counts as one without words; a document whose
labels are null is not learned from, nor are an id or a text whose labels contradict each
other; copies count once; without labelled examples of both kinds a category has its rate
in the sample (0 without any sample); repeated rows each give a row; null ids are passed
through; an empty table gives an empty result; other columns are kept by
``with_toxicity`` (but for those of the names that it gives) and ``drop_toxic``, and not
read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, in_few_files, materialize, packed, release

SAMPLE_DOCS, SAMPLE_LETTERS = 12_000, 100_000_000
FEATURES = 600
LEAST_Z = 4.0
LEAST_TEXTS = 5
KINDS = 3
FOLDS = 3
L1, L2, ROUNDS = 1e-4, 1e-4, 200
#: Lengths of word beginnings.
STEMS = (4, 5, 6)
_WORD = re.compile(r"\w+")


def terms(text: str) -> set[str]:
    """The distinct words of a whole text in lower case, and their beginnings after ^."""
    words = set(_WORD.findall(text.lower()))
    found = set(words)
    for k in STEMS:
        found |= {"^" + w[:k] for w in words if len(w) > k}
    return found


@dataclass
class Chain:
    """Fitted models: for each category its weights of words and of the models before it."""

    categories: list[str]
    words: list[str]
    weights: list[np.ndarray] = field(default_factory=list)  # words, then earlier categories
    bias: list[float] = field(default_factory=list)
    threshold: float = 0.5  # for the last category

    def predict(self, texts) -> np.ndarray:
        """Probabilities, a column for each category, of whole texts."""
        index = {w: k for k, w in enumerate(self.words)}
        base = np.array([w[: len(self.words)] for w in self.weights])
        sums = np.zeros((len(texts), len(self.categories)))
        for row, text in enumerate(texts):
            if text and index:
                hits = [index[w] for w in index.keys() & terms(text)]
                if hits:
                    sums[row] = base[:, hits].sum(axis=1)
        out = np.zeros_like(sums)
        for k in range(len(self.categories)):
            out[:, k] = _sigmoid(sums[:, k] + out[:, :k] @ self.weights[k][len(self.words) :] + self.bias[k])
        return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """L1 logistic regression by accelerated proximal gradient steps.

    Columns are scaled to unit deviation, lest rare words take long to learn.
    """
    rate = float(np.clip(y.mean() if len(y) else 0, 1e-6, 1 - 1e-6))
    bias = float(np.log(rate / (1 - rate)))
    w = np.zeros(x.shape[1])
    if len(y) == 0 or y.min() == y.max() or x.shape[1] == 0:
        return w, bias
    n = len(y)
    scale = np.maximum(x.std(axis=0), 1e-3)
    x = x / scale
    v = np.random.default_rng(0).normal(size=x.shape[1])
    for _ in range(12):  # the largest eigenvalue sets the step
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v) + 1e-12
    step = 1 / (0.25 * (float(v @ (x.T @ (x @ v))) / n + 1) * 1.05 + L2)
    at_w, at_b, t = w, bias, 1.0
    for _ in range(ROUNDS):
        rest = _sigmoid(x @ at_w + at_b) - y
        new_w = at_w - step * (x.T @ rest / n + L2 * at_w)
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * L1, 0)
        new_b = at_b - step * float(rest.mean())
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at_w = new_w + (t - 1) / new_t * (new_w - w)
        at_b = new_b + (t - 1) / new_t * (new_b - bias)
        w, bias, t = new_w, new_b, new_t
    return w / scale, bias


def fit_chain(categories: list[str], words: list[str], x: np.ndarray, y: np.ndarray, folds: int = FOLDS) -> Chain:
    """Fit the models in order; x: presence of words, y: a 0/1 column for each category."""
    chain = Chain(categories, words)
    fold = np.arange(len(x)) % folds
    seen = x
    for k in range(len(categories)):
        w, b = fit_linear(seen, y[:, k])
        chain.weights.append(w)
        chain.bias.append(b)
        held = np.zeros(len(x))
        for f in range(folds):
            wf, bf = fit_linear(seen[fold != f], y[fold != f, k])
            held[fold == f] = _sigmoid(seen[fold == f] @ wf + bf)
        seen = np.column_stack([seen, held])
    if categories and len(x):
        chain.threshold = best_threshold(held, y[:, -1])
    return chain


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut of out-of-fold probabilities with the best F1, in the middle of its gap.

    Penalties pull the probabilities of texts with a single telling word down; the cut
    makes up for that. It stays between 0.1 and 0.9, and is 0.5 with labels of one kind.
    """
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits, taken = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    f1 = 2 * hits / (taken + y.sum())
    ends = np.append(p[order][:-1] > p[order][1:], True)  # only between different values
    k = int(np.argmax(np.where(ends, f1, -1)))
    low = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float(np.clip((p[order][k] + low) / 2, 0.1, 0.9))


def kinds_of(x: np.ndarray, kinds: int, rounds: int = 25) -> np.ndarray:
    """A kind from 0 on for each row of 0/1 features, by the terms that rows share; -1 for a row without any."""
    size = np.linalg.norm(x, axis=1)
    some = np.nonzero(size > 0)[0]
    found = np.full(len(x), -1)
    if not len(some):
        return found
    unit = x[some] / size[some, None]
    # Far-apart seeds: the row nearest to the mean, then ever the one furthest from all seeds.
    seeds = [int(np.argmax(unit @ unit.mean(axis=0)))]
    while len(seeds) < min(kinds, len(unit)):
        seeds.append(int(np.argmin((unit @ unit[seeds].T).max(axis=1))))
    centres, group = unit[seeds], np.full(len(unit), -1)
    for _ in range(rounds):
        new = (unit @ centres.T).argmax(axis=1)
        if (new == group).all():
            break
        group = new
        centres = np.stack([unit[group == k].mean(axis=0) if (group == k).any() else centres[k] for k in range(len(seeds))])
        centres /= np.linalg.norm(centres, axis=1)[:, None]
    found[some] = group
    return found


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text: str, label_cols: list[str], bound: int, letters: int = SAMPLE_LETTERS
) -> DataFrame:
    """At most ``bound`` labelled documents of ``letters`` in all: ``_text`` and the label columns.

    The labels are bounded before the join, so texts are filtered where they are read. An
    id or a text with labels that contradict each other is left out. Which texts are taken
    is settled by their hashes and sizes; a text that has no room left is passed over.
    """
    ys = [f"_y{k}" for k in range(len(label_cols))]

    def agreed(rows: DataFrame, key: str, *more: Column) -> DataFrame:
        """One row for each key, if its labels agree."""
        ends = [f(y).alias(f"{y}{n}") for y in ys for f, n in ((F.min, "a"), (F.max, "b"))]
        one = rows.groupBy(key).agg(*ends, *more).where(" and ".join(f"{y}a = {y}b" for y in ys))
        return one.drop(*(f"{y}b" for y in ys)).withColumnsRenamed({f"{y}a": y for y in ys})

    known = labels.select(F.col(id_col).alias("_id"), *[F.col(c).alias(y) for c, y in zip(label_cols, ys, strict=True)]).dropna()
    few = materialize(agreed(known, "_id").orderBy(F.xxhash64("_id"), "_id").limit(bound), "labels")
    some = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    # A row for each label: at most ``bound`` rows of numbers are broadcast.
    joined = some.join(F.broadcast(few), "_id").drop("_id").withColumn("_key", F.xxhash64("_text"))
    joined = materialize(in_few_files(joined), "labelled-texts")
    sizes = agreed(joined.withColumn("_size", F.length("_text")).drop("_text"), "_key", F.max("_size").alias("_size"))
    keys, room = [], letters
    for r in sizes.select("_key", "_size").orderBy("_key").limit(bound).collect():  # numbers
        if r["_size"] <= room:
            keys.append((r["_key"],))
            room -= r["_size"]
    chosen = docs.sparkSession.createDataFrame(keys, "_key bigint")
    texts = joined.join(F.broadcast(chosen), "_key").groupBy("_key").agg(F.min("_text").alias("_text"), *[F.min(y).alias(y) for y in ys])
    return texts.select("_text", *[F.col(y).alias(c) for c, y in zip(label_cols, ys, strict=True)])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    categories: tuple[str, ...] = ("toxic",),
    kinds: int = KINDS,
    sample_docs: int = SAMPLE_DOCS,
    features: int = FEATURES,
) -> Chain:
    """Fit the chain: ``kinds`` categories found in the texts, then the label columns in their order.

    Labels are 0 or 1; with several label columns 0 kinds leave the chain to those.
    """
    names, last = list(categories), f"_y{len(categories) - 1}"
    sample = labelled_sample(docs, labels, id_col, text, names, sample_docs)
    sample = materialize(sample.select("_text", *[(F.col(c) > 0).cast("int").alias(f"_y{k}") for k, c in enumerate(names)]), "labelled")
    n, n1 = sample.agg(F.count("*"), F.coalesce(F.sum(last), F.lit(0))).first()

    def all_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 64):
                part = pdf.iloc[at : at + 64]
                found = [list(terms(t)) for t in part["_text"]]
                yield pd.DataFrame({"w": [w for f in found for w in f], last: np.repeat(part[last].to_numpy(), [len(f) for f in found])})
        release()

    words = sample.select(last, "_text").mapInPandas(all_terms, f"w string, {last} int")
    seen = words.groupBy("w").agg(F.count("*").alias("n"), F.sum(last).alias("n1"))
    # z of a word's share of positives, against that of the sample.
    rate = n1 / n if n else 0.0
    z = (F.col("n1") - F.col("n") * rate) / F.sqrt(F.col("n") * max(rate * (1 - rate), 1e-9))
    top = seen.where(F.col("n") >= LEAST_TEXTS).withColumn("z", z).where(F.abs("z") >= LEAST_Z).orderBy(F.desc(F.abs("z")), "w").limit(features)
    chosen = [r["w"] for r in top.collect()] if 0 < n1 < n else []
    at = {w: k for k, w in enumerate(chosen)}

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf.pop("_text")
            yield pdf.assign(key=[zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts], hits=[sorted(at[w] for w in at.keys() & terms(t)) for t in texts])

    ys = [f"_y{k}" for k in range(len(names))]
    rows = sample.mapInPandas(present, ", ".join(f"{y} int" for y in ys) + ", key long, hits array<int>").toPandas()
    # The order decides the folds; equal rows may stand in any.
    rows["line"] = rows["hits"].map(lambda h: tuple(h))
    rows = rows.sort_values(["key", "line", *ys], kind="stable")
    x = np.zeros((len(rows), len(chosen)))
    for r, hits in enumerate(rows["hits"]):
        x[r, np.asarray(hits, dtype=int)] = 1
    y = rows[ys].to_numpy(dtype=float).reshape(len(rows), len(names))
    group = np.full(len(rows), -1)
    positive = y[:, -1] > 0
    group[positive] = kinds_of(x[positive], kinds)
    own = np.stack([group == k for k in range(kinds)], axis=1).astype(float) if kinds else np.zeros((len(rows), 0))
    return fit_chain([*(f"kind_{k + 1}" for k in range(kinds)), *names], chosen, x, np.column_stack([own, y]))


def _scored(text: Column, chain: Chain) -> Column:
    """A struct of the probability of each category of whole texts."""
    kind = T.StructType([T.StructField(c, T.DoubleType()) for c in chain.categories])

    @F.pandas_udf(kind)
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for some in texts:
            yield pd.DataFrame(chain.predict(some.tolist()), columns=chain.categories)
        release()

    return scored(text.cast("string"))


def with_toxicity(docs: DataFrame, chain: Chain, *, text: str = "text", prefix: str = "p_") -> DataFrame:
    """``docs`` with the probability of each category, in place of columns of these names."""
    found, new = fresh(docs, "scored"), {prefix + c: c for c in chain.categories}
    others = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    return docs.withColumn(found, _scored(F.col(text), chain)).select(*others, *[F.col(f"{found}.{c}").alias(n) for n, c in new.items()])


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", threshold: float | None = None) -> DataFrame:
    """``id_col``, the probability of each category, and whether the text is toxic."""
    chain = learn(docs, labels, id_col=id_col, text=text)
    scored = with_toxicity(docs.select(F.col(id_col), F.col(text).alias("_text")), chain, text="_text").drop("_text")
    return scored.withColumn("toxic", F.col(f"p_{chain.categories[-1]}") >= (chain.threshold if threshold is None else threshold))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", threshold: float | None = None) -> DataFrame:
    """``docs`` without the documents that the chain finds toxic."""
    chain = learn(docs, labels, id_col=id_col, text=text)
    threshold = chain.threshold if threshold is None else threshold
    scored = docs.select(packed(docs).alias("_doc"), _scored(F.col(text), chain).alias("_p"))
    return scored.where(F.col(f"_p.{chain.categories[-1]}") < threshold).select("_doc.*")
