"""Quality by hierarchical empirical Bayes.

A linear classifier over counts of a text's letters, signs, words and lines gives each
document's evidence. Hosts and paths then get posteriors of their share of good
documents by grouped aggregation: a host's is shrunk toward the global share and a
path's toward its host's, the more so the fewer documents there are; how strongly is
estimated from the spread of the groups (method of moments). A document's log odds are
its own plus the log odds by which its path, counted without it, differs from the whole.

The classifier is fitted on a bounded labelled sample; all posteriors rest on all
documents. Groups are pre-aggregated before the exchange, so a hot host costs no more
than another; the table of paths is broadcast only if it has at most ``BROADCAST_PATHS``
rows, else joined by a shuffle.

Defined results: a null or empty text has no evidence (probability = the sample's share
of good documents); null hosts or paths form groups of their own; without labels, or
with labels of one kind alone, that share, or 1 without any, is all evidence there is;
an id or a text whose labels contradict each other is not learned from, copies count once;
repeated rows each give a row; null ids are passed through; an empty table gives an
empty result; other columns are kept by ``drop_poor`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_few_files, materialize, packed, release
from .toxicity import labelled_sample

SAMPLE_DOCS = 12_000
BROADCAST_PATHS = 200_000
_EDGE = 1e-4
_STRENGTH = (1.0, 1e6)

#: Fixed classes of bytes whose shares are features; bytes above 127 count as letters.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".,;:?'\"()-",
    "shout": b"!",
    "bar": b"|",
    "line": b"\n",
    "space": b" \t",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
}
FEATURES = (*_CLASSES, "length", "word_length", "distinct_words", "distinct_lines", "top_word", "wordless")
_TABLE = np.zeros((256, len(_CLASSES)))
for _k, _some in enumerate(_CLASSES.values()):
    _TABLE[list(_some), _k] = 1


def features(texts) -> np.ndarray:
    """One row of FEATURES for each whole text; zeros for a null or empty one."""
    out = np.zeros((len(texts), len(FEATURES)))
    k = len(_CLASSES)
    for row, text in enumerate(texts):
        if not text:
            continue
        raw = text.encode("utf-8", "surrogatepass")
        counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
        words, lines = raw.split(), raw.split(b"\n")
        many: dict[bytes, int] = {}
        for w in words:
            many[w] = many.get(w, 0) + 1
        out[row, :k] = np.sqrt(counts @ _TABLE / len(raw))
        n = max(1, len(words))
        # Distinct words fall with the length of any text: compare with its square root.
        out[row, k:] = (
            np.log1p(len(raw)), np.log1p(len(raw) / n), np.log((len(many) + 1) / np.sqrt(n + 1)), len(set(lines)) / len(lines), max(many.values(), default=0) / n, not words,
        )
    return out


@dataclass
class Evidence:
    """A fitted classifier: standardised features and their squares, and weights."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    share: float

    def predict(self, texts) -> np.ndarray:
        x = expanded(features(texts), self.mean, self.scale)
        p = 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))
        return np.where([bool(t) for t in texts], p, self.share)


def expanded(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -8, 8)
    return np.column_stack([z, z**2])


def fit_evidence(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> Evidence:
    """Logistic regression by Newton steps."""
    share = float(y.mean()) if len(y) else 1.0
    mean, scale = (x.mean(axis=0), x.std(axis=0)) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    scale = np.where(scale < 1e-9, 1, scale)
    clipped = float(np.clip(share, _EDGE, 1 - _EDGE))
    bias = float(np.log(clipped / (1 - clipped)))
    z = expanded(x, mean, scale)
    w = np.zeros(z.shape[1])
    if len(y) and 0 < share < 1:
        a = np.column_stack([z, np.ones(len(z))])
        wb = np.append(w, bias)
        penalty = np.append(np.full(len(w), ridge * len(y) / 100), 0)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(a @ wb, -30, 30)))
            grad = a.T @ (p - y) + penalty * wb
            hess = (a * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ a + np.diag(penalty + 1e-9)
            move = np.linalg.solve(hess, grad)
            wb = wb - move * min(1.0, 5 / (np.abs(move).max() + 1e-12))
            if np.abs(move).max() < 1e-6:
                break
        w, bias = wb[:-1], float(wb[-1])
    return Evidence(mean, scale, w, bias, share)


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "quality", sample_docs: int = SAMPLE_DOCS) -> Evidence:
    """Fit the classifier on a bounded sample of the labelled documents."""
    sample = labelled_sample(docs, labels, id_col, text, [label], sample_docs).select("_text", (F.col(label) > 0).cast("double").alias("_y"))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"x": list(features(pdf["_text"].tolist())), "y": pdf["_y"]})

    rows = sample.mapInPandas(measured, "x array<double>, y double").toPandas()
    x = np.stack(rows["x"].to_numpy()) if len(rows) else np.zeros((0, len(FEATURES)))
    return fit_evidence(x, rows["y"].to_numpy(dtype=float))


def evidence(text: Column, model: Evidence) -> Column:
    """Probability that each whole text is good, by itself."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            yield pd.Series(model.predict(some.tolist()))
        release()

    return scored(text.cast("string"))


def _strength(groups: DataFrame, total: str, good: str, around: Column) -> float:
    """Pseudo-count of the Beta prior that the spread of the groups calls for."""
    n, s = F.col(total), F.col(good)
    row = groups.agg(
        F.sum(n).alias("n"), F.count("*").alias("g"), F.sum(n * (s / n - around) ** 2).alias("between"), F.sum(n * around * (1 - around)).alias("within")
    ).first()
    if not row["n"]:
        return _STRENGTH[1]
    within = row["within"] / row["n"]
    spread = row["between"] / row["n"] - within * row["g"] / row["n"]
    return float(np.clip(within / spread - 1, *_STRENGTH)) if spread > 1e-9 else _STRENGTH[1]


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float, float]:
    """Paths (``_host``, ``_path``, ``_n``, ``_good``, ``_prior``), the path strength, the global share.

    ``scored`` has ``_host``, ``_path`` and the evidence ``_p``; ``_prior`` is the
    posterior of the host.
    """
    paths = materialize(scored.groupBy("_host", "_path").agg(F.count("*").alias("_n"), F.sum("_p").alias("_good")), "paths", narrow=True)
    hosts = materialize(paths.groupBy("_host").agg(F.sum("_n").alias("_hn"), F.sum("_good").alias("_hgood")), "hosts", narrow=True)
    n, good = hosts.agg(F.sum("_hn"), F.sum("_hgood")).first()
    share = float(np.clip(good / n, _EDGE, 1 - _EDGE)) if n else 1 - _EDGE
    strength = _strength(hosts, "_hn", "_hgood", F.lit(share))
    posterior = (F.lit(strength * share) + F.col("_hgood")) / (F.lit(strength) + F.col("_hn"))
    known = hosts.select(F.col("_host").alias("_h"), posterior.alias("_prior"))
    joined = paths.join(known, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h")
    joined = materialize(joined, "path-priors", narrow=True)
    return joined, _strength(joined, "_n", "_good", F.col("_prior")), share


def _final(p: Column, strength: float, share: float) -> Column:
    """Probability from the document's evidence and its path without it."""
    logit = lambda c: F.log(F.greatest(F.least(c, F.lit(1 - _EDGE)), F.lit(_EDGE)) / (1 - F.greatest(F.least(c, F.lit(1 - _EDGE)), F.lit(_EDGE))))
    site = (F.lit(strength) * F.col("_prior") + F.col("_good") - p) / (F.lit(strength) + F.col("_n") - 1)
    return 1 / (1 + F.exp(-(logit(p) + logit(site) - logit(F.lit(share)))))


def _with_sites(rows: DataFrame, paths: DataFrame) -> DataFrame:
    sites = paths.select(F.col("_host").alias("_h"), F.col("_path").alias("_q"), "_n", "_good", "_prior")
    if paths.count() <= BROADCAST_PATHS:
        sites = F.broadcast(sites)
    return rows.join(sites, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_q"))).drop("_h", "_q")


def quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang", threshold: float = 0.5
) -> DataFrame:
    """``id_col``, ``p_text``, ``p_site``, ``p_good`` and ``good``, per document."""
    model = learn(docs, labels, id_col=id_col, text=text)
    scored = docs.select(F.col(id_col).alias("_id"), F.col(host).alias("_host"), F.col(path).alias("_path"), evidence(F.col(text), model).alias("_p"))
    scored = materialize(in_few_files(scored), "evidence")
    paths, strength, share = site_posteriors(scored)
    site = (F.lit(strength) * F.col("_prior") + F.col("_good")) / (F.lit(strength) + F.col("_n"))
    final = in_few_files(_with_sites(scored, paths)).withColumn("p_good", _final(F.col("_p"), strength, share))
    return final.select(F.col("_id").alias(id_col), F.col("_p").alias("p_text"), site.alias("p_site"), "p_good", (F.col("p_good") >= threshold).alias("good"))


def drop_poor(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang", threshold: float = 0.5
) -> DataFrame:
    """``docs`` without those whose probability to be good is under ``threshold``.

    The evidence is computed twice, for the sums and for the filter, so that no text is
    stored or (while the paths are few) shuffled.
    """
    model = learn(docs, labels, id_col=id_col, text=text)
    rows = docs.select(packed(docs).alias("_doc"), F.col(host).alias("_host"), F.col(path).alias("_path"), evidence(F.col(text), model).alias("_p"))
    paths, strength, share = site_posteriors(rows.select("_host", "_path", "_p"))
    final = _with_sites(rows, paths).where(_final(F.col("_p"), strength, share) >= threshold)
    return final.select("_doc.*")
