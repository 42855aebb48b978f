"""op2, op5 and op10: held-out accuracy, laws, and messy rows."""

import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language, quality, toxicity
from millrace.llm.common import release

from .conftest import MESSY


def test_chain_finds_held_out_toxic_texts(spark):
    rng = random.Random(1)
    plain = ["river", "stone", "cloud", "paper", "green", "walk", "table", "song", "light", "winter"]
    bad = ["idiot", "scum", "vadrozu", "vadrone"]
    rows = []
    for k in range(1200):
        words = [rng.choice(plain) + rng.choice(["", "s", "ing"]) for _ in range(rng.randrange(5, 60))]
        toxic = k % 6 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad).upper() + "!"
        rows.append((k, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity.toxicity(docs.select("doc_id", "text"), docs.where("doc_id < 800").select("doc_id", "toxic"))
    got = {r["doc_id"]: r["toxic"] for r in out.collect()}
    wrong = [k for k, _, y in rows if k >= 800 and got[k] != bool(y)]
    assert len(got) == 1200 and not wrong
    new = spark.createDataFrame([(1, "a vadroli stone"), (2, "a quiet stone")], "doc_id long, text string")
    chain = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert [r["p_toxic"] >= 0.5 for r in toxicity.with_toxicity(new, chain).orderBy("doc_id").collect()] == [True, False]


def test_chain_trains_on_out_of_fold_probabilities():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, size=(300, 20)).astype(float)
    noise = rng.integers(0, 2, size=300).astype(float)
    y = np.column_stack([noise, noise])
    chain = toxicity.fit_chain(["a", "b"], [f"w{k}" for k in range(20)], x, y)
    assert len(chain.weights[1]) == 21
    # Out of fold, the first model's guess of pure noise is worth little to the second.
    assert chain.weights[1][20] < 2


@pytest.mark.parametrize("labelled", ["real", "none", "one kind"])
def test_messy_toxicity_and_quality(spark, messy, no_docs, labelled):
    rows = {"real": [(7, 1, 0), (3, 1, 0), (12, 0, 1), (13, 0, 1), (11, None, 1), (None, 1, 1)], "none": [], "one kind": [(7, 1, 0), (3, 1, 0)]}[labelled]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for df, n in ((messy, len(MESSY)), (no_docs, 0)):
        t = toxicity.toxicity(df, labels).collect()
        q = quality.quality(df, labels).collect()
        assert len(t) == len(q) == n
        assert all(0 <= r["p_toxic"] <= 1 for r in t) and all(0 <= r["p_good"] <= 1 for r in q)
        assert toxicity.drop_toxic(df, labels).columns == quality.drop_poor(df, labels).columns == df.columns


def test_quality_on_labels(documents, labels, spark):
    rows = quality.quality(documents, labels).join(labels, "doc_id").collect()
    right = np.mean([r["good"] == bool(r["quality"]) for r in rows])
    assert right > 0.95
    kept = quality.drop_poor(documents, labels)
    assert kept.count() == quality.quality(documents, labels).where("good").count()


def test_final_probabilities_match_plain_python(documents, labels):
    """Global share, strengths, posteriors and the final probability, from the texts' own evidence."""
    rows = quality.quality(documents, labels).join(documents.select("doc_id", "source", "lang"), "doc_id").collect()
    edge = lambda p: min(max(p, 1e-4), 1 - 1e-4)
    logit = lambda p: np.log(edge(p) / (1 - edge(p)))
    sums = lambda key: {k: (sum(key(r) == k for r in rows), sum(r["p_text"] for r in rows if key(r) == k)) for k in {key(r) for r in rows}}
    hosts, paths = sums(lambda r: r["source"]), sums(lambda r: (r["source"], r["lang"]))
    share = edge(sum(r["p_text"] for r in rows) / len(rows))

    def strength(groups):  # (n, good, prior) of each
        n = sum(g[0] for g in groups)
        between, within = (sum(f(*g) for g in groups) / n for f in (lambda m, s, a: m * (s / m - a) ** 2, lambda m, s, a: m * a * (1 - a)))
        spread = between - within * len(groups) / n
        return float(np.clip(within / spread - 1, 1.0, 1e6)) if spread > 1e-9 else 1e6

    over = strength([(n, s, share) for n, s in hosts.values()])
    prior = {h: (over * share + s) / (over + n) for h, (n, s) in hosts.items()}
    under = strength([(n, s, prior[k[0]]) for k, (n, s) in paths.items()])
    for r in rows:
        k = (r["source"], r["lang"])
        n, s = paths[k]
        others = (under * prior[k[0]] + s - r["p_text"]) / (under + n - 1)
        want = 1 / (1 + np.exp(-(logit(r["p_text"]) + logit(others) - logit(share))))
        assert abs(r["p_good"] - want) < 1e-9 and r["good"] == (r["p_good"] >= 0.5)
        assert abs(r["p_site"] - (under * prior[k[0]] + s) / (under + n)) < 1e-9


def test_evidence_is_fitted_to_the_optimum():
    """The gradient of the penalised likelihood is 0 at the weights."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    y = (rng.random(400) < 1 / (1 + np.exp(-x[:, 0] - 0.5 * x[:, 1]))).astype(float)
    e = quality.fit_evidence(x, y)
    z = quality.expanded(x, e.mean, e.scale)
    rest = 1 / (1 + np.exp(-(z @ e.weights + e.bias))) - y
    assert np.abs(z.T @ rest + 1e-2 * len(y) / 100 * e.weights).max() < 1e-4 and abs(rest.sum()) < 1e-4


def test_chain_predicts_one_after_the_other(documents, labels):
    """Probabilities by plain Python: each model sees the terms and the probabilities before its own."""
    chain = toxicity.learn(documents, labels)
    assert chain.categories == ["kind_1", "kind_2", "kind_3", "toxic"]
    some = documents.where(F.length("text") < 3000).limit(60)
    for r in toxicity.with_toxicity(some, chain).collect():
        found, before = toxicity.terms(r["text"]), []
        for k, name in enumerate(chain.categories):
            w = chain.weights[k]
            z = chain.bias[k] + sum(w[i] for i, term in enumerate(chain.words) if term in found) + sum(w[len(chain.words) + j] * p for j, p in enumerate(before))
            before.append(1 / (1 + np.exp(-z)))
            assert abs(r[f"p_{name}"] - before[-1]) < 1e-9


def test_kinds_are_found_in_the_texts():
    """Rows of one vocabulary are one kind; rows without any term have none."""
    x = np.zeros((90, 30))
    rng = np.random.default_rng(2)
    for r in range(80):
        x[r, 10 * (r % 3) + rng.choice(10, size=4, replace=False)] = 1
    kinds = toxicity.kinds_of(x, 3)
    assert (kinds[80:] == -1).all() and {tuple(set(kinds[k:80:3])) for k in range(3)} == {(0,), (1,), (2,)}
    assert (toxicity.kinds_of(np.zeros((0, 5)), 3) == np.zeros(0)).all()


def test_contradicting_labels_are_left_out(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "c"), (4, "d"), (5, "e"), (5, "f"), (6, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (4, 1), (4, 1), (5, 0), (6, 0), (7, 1), (None, 1), (4, None)], "doc_id long, y int")
    got = toxicity.labelled_sample(docs, labels, "doc_id", "text", ["y"], 100).collect()
    assert sorted((r["_text"], r["y"]) for r in got) == [("", 0), ("d", 1), ("e", 0), ("f", 0)]
    assert toxicity.labelled_sample(docs, labels, "doc_id", "text", ["y"], 2).count() <= 2
    assert {r["_text"] for r in toxicity.labelled_sample(docs, labels, "doc_id", "text", ["y"], 100, letters=0).collect()} == {""}


def test_sites_are_shrunk(spark):
    """A site of one document stays near the prior; a large bad one does not."""
    rows = [("big", "p", 0.05)] * 400 + [("good", "p", 0.95)] * 400 + [("tiny", "p", 0.05)] + [(None, None, 0.9)] * 3
    scored = spark.createDataFrame(rows, "_host string, _path string, _p double")
    paths, strength, share = quality.site_posteriors(scored)
    got = {r["_host"]: r["_prior"] for r in paths.collect()}
    assert 0.45 < share < 0.55 and got["big"] < 0.1 and got["good"] > 0.9
    assert abs(got["tiny"] - share) < abs(got["big"] - share) and None in got
    assert strength >= 1


def test_posteriors_match_plain_python(spark):
    rng = np.random.default_rng(5)
    rows = [(f"h{rng.integers(6)}", f"p{rng.integers(3)}", float(rng.random())) for _ in range(500)]
    paths, _, share = quality.site_posteriors(spark.createDataFrame(rows, "_host string, _path string, _p double"))
    assert abs(share - np.mean([p for *_, p in rows])) < 1e-12
    for r in paths.collect():
        mine = [p for h, q, p in rows if (h, q) == (r["_host"], r["_path"])]
        assert r["_n"] == len(mine) and abs(r["_good"] - sum(mine)) < 1e-9


def test_evidence_of_other_features():
    texts = ["", None, "A plain line of text.\nAnd one more of them.", "BUY!!! NOW!!! " * 50]
    x = quality.features(texts)
    assert x.shape == (4, len(quality.FEATURES)) and not x[:2].any() and x[3, 0] > x[2, 0]


def brute_phrases(train, text):
    n = at = 0
    while at < len(text):
        k = 0
        while at + k < len(text) and text[at : at + k + 1] in train:
            k += 1
        at += max(1, k)
        n += 1
    return n


def test_automaton_takes_exactly_the_substrings():
    """Phrases of the parse from the first letter, whatever the blocks."""
    rng = random.Random(2)
    code = lambda text: np.array([ord(c) for c in text], dtype=np.int64)
    for _ in range(60):
        train = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 60)))
        automaton = language.Automaton(code(train))
        texts = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(0, 70))) for _ in range(20)]
        edges = np.cumsum([0, *map(len, texts)])
        for block in (1, 2, 7, 30, 1000):
            assert automaton.phrases(code("".join(texts)), edges, block).tolist() == [brute_phrases(train, t) for t in texts]


def plain_running(text):
    """Running text, letter by letter."""
    out = " "
    for c in text.lower():
        out += c if unicodedata.category(c)[0] in "LM" else "" if out[-1] == " " else " "
    return out.rstrip(" ") + " "


def brute_language(labelled, text):
    """The language of least bits a letter by plain search in the joined labelled texts."""
    if not any(unicodedata.category(c)[0] == "L" for c in (text or "").lower()):
        return "und", 0.0
    read, bits = plain_running(text), {}
    for lang, texts in labelled:
        some = [plain_running(t) + "\n" for t in texts if any(c.isalpha() for c in t)]
        if some:
            bits[lang] = brute_phrases("".join(some), read) * np.log2(max(2, sum(map(len, some)))) / len(read)
    if not bits:
        return "und", 0.0
    best = min(sorted(bits), key=bits.get)
    return best, 1 / sum(2 ** (bits[best] - b) for b in bits.values())


def test_language_is_that_of_least_entropy(documents):
    """The operator against plain search in the same labelled texts, and texts without letters."""
    train = [(r["lang"], r["text"]) for r in documents.where(F.length("text") < 1500).limit(60).collect()]
    labelled = tuple((g, tuple(t for h, t in train if h == g)[:6]) for g in sorted({g for g, _ in train}))
    texts = [r["text"] for r in documents.where(F.length("text") < 3000).limit(50).collect()]
    texts += [None, "", "½ ²", "Ⅷ ① 12", "ñ", "日本", "a\u0301\u0301 b", "12 die und 34", "der und\nthe" * 300]
    langs, scores = language.Parser(labelled).predict(texts)
    want = [brute_language(labelled, t) for t in texts]
    assert langs == [g for g, _ in want] and np.allclose(scores, [s for _, s in want])
    assert langs[50:54] == ["und"] * 4 and langs[54] != "und" and not scores[50:54].any()


def test_the_sample_is_bounded_in_whole_texts(spark):
    rows = [(k, f"text number {k} " * 3, "en") for k in range(300)] + [(1000 + k, "copy of a text", "en") for k in range(300)]
    rows += [(5000, "viele Worte " * 500, "de"), (5001, "wenige Worte " * 100, "de"), (6000, None, "fr"), (None, "sans", "fr"), (7000, "12", "it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    texts = {t for _, t, _ in rows}
    learned = dict(language.learn(docs, sample_docs=40, sample_letters=700))
    assert set(learned) == {"en", "de", "it"} and set(learned["en"]) <= texts
    assert sum(map(len, learned["en"])) <= 700 and len(learned["en"]) == len(set(learned["en"])) > 5
    assert learned["de"] == ("wenige Worte " * 100,)  # neither fits: the shortest
    assert language.learn(docs, sample_docs=40, sample_letters=700) == tuple(sorted(learned.items()))


def test_language_held_out(documents):
    out = language.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_messy(spark, messy, no_docs):
    got = language.identify(messy)
    rows = got.collect()
    assert len(rows) == len(MESSY) and language.identify(no_docs).count() == 0
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert {4, 5, 9} <= und and not {7, 3} & und
    assert all(r["held_out"] is not None for r in rows)
    nothing = messy.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(nothing).collect()} == {"und"}


def test_language_prediction_reads_text_alone(documents):
    words = language.learn(documents)
    other = documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y"))
    a = {r["doc_id"]: r["lang_pred"] for r in language.with_language(documents, words).collect()}
    b = {r["doc_id"]: r["lang_pred"] for r in language.with_language(other, words).collect()}
    assert a == b


def test_quality_writes_few_files(spark, labels, documents, monkeypatch):
    """However many parts the documents come in: an executor forks for each file that it writes."""
    written = {}

    def counted(df, tag, narrow=False, materialize=quality.materialize):
        out = materialize(df, tag, narrow)
        written[tag] = len(out.inputFiles())
        return out

    for module in (quality, toxicity):
        monkeypatch.setattr(module, "materialize", counted)
    out = quality.quality(documents.repartition(40), labels)
    cores = spark.sparkContext.defaultParallelism
    assert out.rdd.getNumPartitions() <= cores and {"evidence", "labelled-texts"} <= set(written)
    assert max(written["evidence"], written["labelled-texts"]) <= cores


def test_workers_give_memory_back():
    import psutil
    import pyarrow as pa

    held = [bytes(1000) + bytes([k % 250]) for k in range(200_000)]
    kept = [held[-1], pa.array(held)]
    resident = lambda: psutil.Process().memory_info().rss
    before = resident()
    del held, kept
    release()
    assert resident() < before - 200e6
