"""The pipeline's near-duplicate stage against all pairs by five-word Jaccard similarity."""

import random

import numpy as np

import corpus_pipeline
from millrace.llm import shingle_sets, simhash

from .test_near_duplicates import Union


def grams(text):
    w = (text or "").lower().split()
    return {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """The ids kept: the least of each component of the pairs alike to 0.8 or more."""
    sets, groups = {i: grams(t) for i, t in rows}, Union()
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                groups.join(a, b)
    return {groups.root(i) for i in ids}


def check(spark, sf_dir, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [r["doc_id"] for r in corpus_pipeline.drop_copies(spark, docs, sf_dir).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    return got


def test_planted(spark, sf_dir, monkeypatch):
    """One changed word in texts of 20 to 200 words, chains, common passages, short texts."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(30)]
    texts = [None, "", " ", "a", "A", "a b", "a b c d e", "a b c d e f"]
    for n in (20, 40, 45, 46, 60, 100, 200):
        for _ in range(4):
            w = [word() for _ in range(n)] + passage * rng.randrange(2)
            texts.append(" ".join(w))
            for _ in range(3):
                w[rng.randrange(len(w))] = word()
                texts.append(" ".join(w))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert len(check(spark, sf_dir, rows)) < len({t for _, t in rows}) - 20
    monkeypatch.setattr(shingle_sets, "FEW_SETS", 0)
    check(spark, sf_dir, rows)


def test_documents(spark, sf_dir, documents):
    check(spark, sf_dir, [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()])


def test_a_large_group_of_near_copies(spark, sf_dir):
    """Each a few words from one text, so most pairs fall short of 0.8 while all link through it or each other."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    texts = [" ".join(base)]
    for _ in range(120):
        w = list(base)
        for _ in range(rng.choice([1, 2, 4])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    other = [f"v{rng.randrange(5000)}" for _ in range(60)]
    texts += [" ".join(base[:60] + rng.sample(other, 60)) for _ in range(40)]  # a passage in common
    check(spark, sf_dir, list(enumerate(texts)))


def test_the_plan_holds_its_sum_and_spares_hot_parts():
    """Thresholds sum to parts less one; a part whose bits hardly vary is not searched while another takes more."""
    rng = np.random.default_rng(3)
    sample = rng.integers(-(2**63), 2**63 - 1, size=(400, 3), dtype=np.int64)
    plan = simhash.plan_wide(sample, 10**6, 8, 20)
    assert sum(t + 1 for _, t in plan) == 8 and len({b for part, _ in plan for b in part}) == sum(len(part) for part, _ in plan)
    sample[:, 0] = 5  # three parts without any difference
    hot = simhash.plan_wide(sample, 10**6, 8, 20)
    assert sum(t + 1 for _, t in hot) == 8 and any(t == 1 for _, t in hot)
    assert not any(t >= 0 and all(b < 64 for b in part) for part, t in hot)


def test_wide_shape_keeps_the_recall():
    for total in (2, 1000, 10**6, 10**9):
        parts, width = simhash.wide_shape(total, 0.8)
        share = 1 - np.arccos(2 * 0.8 / 1.8) / np.pi
        assert 1 - (1 - share**width) ** parts >= simhash.RECALL and 2**width >= total
