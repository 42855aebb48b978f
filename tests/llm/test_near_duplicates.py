"""op7 and op8 against all pairs, and components against union-find."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import embedding_dedup, queries, simhash
from millrace.llm.components import connected_components
from tests.oracle import database, same

from .conftest import LONG, MESSY


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def brute_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


@pytest.mark.parametrize("text", [None, "", "  ", "A", "A b", "a B c", "É Ä x\x0by\xa0z", LONG[:4000], "x " * 70000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_are_all_pairs(spark, radius):
    rng = random.Random(radius)
    fps = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(12):
            y = x
            for _ in range(rng.randrange(4)):
                y ^= 1 << rng.randrange(64)
            fps.add(y - (1 << 64) if y >> 63 else y)
    df = spark.createDataFrame([(x,) for x in fps], "_fp long")
    got = {(r["a"], r["b"]) for r in simhash.links(df, radius).collect()}
    some = sorted(fps)
    assert got == {(a, b) for k, a in enumerate(some) for b in some[k + 1 :] if ((a ^ b) % (1 << 64)).bit_count() <= radius}


def test_plan_keeps_the_pigeonhole_sum():
    rng = np.random.default_rng(1)
    skewed = (rng.integers(0, 2**62, 500) & ~np.int64(0xFFFF)).tolist()
    for sample, n in ((skewed, 10**6), (skewed, 10**11), ([], 0), ([5], 1)):
        for radius in (1, 2, 3):
            plan = simhash.plan_search(sample, n, radius)
            bits = [b for part, _ in plan for b in part]
            assert len(set(bits)) == len(bits)
            # Parts with threshold -1 are left out: m parts in all, sum = radius - m + 1.
            m = radius + 1 - sum(t + 1 for _, t in plan) + len(plan)
            assert sum(t + 1 for _, t in plan) == radius + 1 and m >= 0


def test_documents_and_messy(spark, documents, messy):
    for df in (documents, messy):
        rows = df.select("doc_id", "text").collect()
        got = simhash.near_duplicates(df).collect()
        assert len(got) == len(rows)
        fp = {r["text"]: brute_fingerprint(r["text"]) if len(r["text"] or "") < 3000 else simhash.fingerprint(r["text"]) % (1 << 64) for r in rows}
        u = Union()
        some = sorted(set(fp.values()))
        for k, a in enumerate(some):
            for b in some[k:]:
                if (a ^ b).bit_count() <= 2:
                    u.join(a, b)
        least = {}
        for r in rows:
            if r["doc_id"] is not None:
                root = u.root(fp[r["text"]])
                least[root] = min(least.get(root, r["doc_id"]), r["doc_id"])
        want = sorted((str(r["doc_id"]), f"{fp[r['text']]:016x}", str(least.get(u.root(fp[r["text"]])))) for r in rows)
        assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want
        kept = simhash.keep_one(df)
        assert kept.columns == df.columns
        assert kept.count() == len({r["component_id"] for r in got})


def test_empty(spark, no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicate_vectors(none).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 180)] + [(1000, k) for k in range(1001, 1060)] + [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(110)] + [(5, 5), (None, 4)]
    u = Union()
    for a, b in edges:
        if a is not None and a != b:
            u.join(a, b)
    df = spark.createDataFrame(edges + edges[:5], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(df, "a", "b").collect()}
    assert got == {x: u.root(x) for x in u.up}


def clusters(rng, dims=64):
    rows = []
    for label in (0, 1, None):
        for c in range(12):
            centre = rng.normal(size=dims)
            for _ in range(int(rng.integers(1, 25))):
                rows.append(((centre + rng.normal(size=dims) * rng.choice([0, 0.05, 0.13, 0.15, 0.2])).tolist(), label))
    # Chains just around the threshold, copies, scaled copies, and what is not valid.
    v = np.zeros(dims)
    for k in range(30):
        v[0], v[1] = np.cos(k * 0.2), np.sin(k * 0.2)
        rows.append((v.tolist(), 0))
    rows += [(rows[0][0], 0)] * 40 + [([x * 1e-30 for x in rows[0][0]], 0), ([0.0] * dims, 0), ([float("nan")] + [1.0] * (dims - 1), 0), (None, 0), ([None] + [1.0] * (dims - 1), 1), ([float("inf")] * dims, 1), ([], 1), ([1.0, 0.0], 1), ([1.0, 0.0], 1)]
    return rows


@pytest.mark.parametrize("tile", [8192, 40])
def test_vectors_against_all_pairs(spark, tile):
    rows = clusters(np.random.default_rng(7))
    data = [(k * 3, v, label) for k, (v, label) in enumerate(rows)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicate_vectors(df.withColumn("_row", F.lit(1)), tile=tile).collect()}
    good = [(i, np.array(v), label) for i, v, label in data if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    u, links = Union(), dict.fromkeys(got, 0)
    for k, (i, x, a) in enumerate(good):
        for j, y, b in good[k + 1 :]:
            if a == b and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                u.join(i, j)
                links[i] += 1
                links[j] += 1
    assert len(got) == len(data)
    for i, r in got.items():
        assert (r["n_links"], r["component_id"], r["kept"]) == (links[i], u.root(i), u.root(i) == i)


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 1500)) * np.exp(rng.normal(size=(50, 1500)))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    q, s, c, e = embedding_dedup.quantise(unit)
    approx = embedding_dedup._products(q, q) * s[:, None] * s[None, :]
    assert (np.abs(unit @ unit.T - approx) <= c[:, None] * e[None, :] + e[:, None] + 1e-9).all()


def test_sql(spark, sf_dir):
    name = "op7_int8_embedding_dedup"
    same(queries.QUERIES[name](spark, sf_dir), database(sf_dir), queries.ORACLE[name])


def test_messy_has_ties():
    assert len({t for _, t, *_ in MESSY}) < len(MESSY)
