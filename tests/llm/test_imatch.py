"""op3 against plain Python for texts, and its laws for fingerprints."""

import hashlib
from collections import Counter

import regex
import xxhash
from pyspark.sql import functions as F

from millrace.llm import imatch

from .conftest import MESSY


def edits(rows):
    """{(id, text): edited sha} in descending order of ids, nulls last."""
    out = []
    for k, (i, text) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        out.append((str(i), hashlib.sha256((text[: len(text) - half] + follow[:half]).encode()).hexdigest(), len(text)))
    return sorted(out)


def test_documents(documents):
    rows = sorted(((r["doc_id"], r["text"]) for r in documents.collect()), reverse=True)
    got = imatch.edited_fingerprints(documents).collect()
    assert sorted((str(r["doc_id"]), r["edited_sha256"], r["n_chars"]) for r in got) == edits(rows)
    text = dict(rows)
    prints = {}
    for r in got:
        assert prints.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        if r["fingerprint"] == r["edited_fingerprint"]:
            assert r["near_edited"] == 1
    nearer = sum(r["near_edited"] > r["near_next"] for r in got)
    assert nearer > 0.6 * len(got)


def test_messy_rows_each_have_one(messy, no_docs):
    got = imatch.edited_fingerprints(messy).collect()
    assert len(got) == len(MESSY)
    order = sorted(((i, t or "") for i, t, *_ in MESSY if i is not None), key=lambda r: -r[0]) + [(None, t) for i, t, *_ in MESSY if i is None]
    assert sorted((str(r["doc_id"]), r["edited_sha256"], r["n_chars"]) for r in got) == edits(order)
    assert imatch.edited_fingerprints(no_docs).count() == 0


def test_one_row_follows_itself(spark):
    df = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    row = imatch.edited_fingerprints(df).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and row["near_next"] == 1


def test_many_ranges_keep_the_order(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_ROWS", 2)
    monkeypatch.setattr(imatch, "CELLS", 3)
    rows = [(k * k * 7 - 5000, f"text {k} " * (k % 9)) for k in range(200)] + [(10**15, "far"), (10**15 + 1, "away")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = imatch.edited_fingerprints(df).collect()
    assert sorted((str(r["doc_id"]), r["edited_sha256"], r["n_chars"]) for r in got) == edits(sorted(rows, reverse=True))


def test_null_ids_are_ordered_by_hash(spark):
    rows = [(None, f"t{k}") for k in range(50)] + [(1, "one"), (2, "two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ties = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = [(2, "two"), (1, "one")] + sorted(rows[:50], key=lambda r: -ties[r[1]])
    assert sorted((str(r["doc_id"]), r["edited_sha256"], r["n_chars"]) for r in imatch.edited_fingerprints(df).collect()) == edits(order)


def test_lexicon_is_the_band(spark):
    df = spark.createDataFrame([(k, "every " + ("half " if k % 2 else "") + ("tenth " if k % 10 == 0 else "") + f"own{k}") for k in range(100)], "doc_id long, text string")
    hashes = {r["w"]: r["h"] for r in spark.createDataFrame([("every",), ("half",), ("tenth",), ("own3",)], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    assert imatch.lexicon(df, least=0.05, most=0.6) == sorted([hashes["half"], hashes["tenth"]])
    # A term outside the band does not move the fingerprint.
    a, b = spark.createDataFrame([(1, "half tenth"), (2, "tenth every HALF own5")], "doc_id long, text string"), imatch.lexicon(df, least=0.05, most=0.6)
    sigs = [r["s"] for r in a.select(imatch.signatures(imatch.term_hashes(F.col("text")), b).alias("s")).collect()]
    assert sigs[0] == sigs[1]


def spark_hash(values, seed=42):
    """xxhash64 of an array of longs, or of a text."""
    if isinstance(values, str):
        h = xxhash.xxh64_intdigest(values.encode(), seed)
    else:
        h = seed
        for v in values:
            h = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), h)
    return h - 2**64 if h >= 2**63 else h


def plain_signatures(text, lexicon):
    terms = sorted({spark_hash(w) for w in regex.findall(r"[\p{L}\p{N}]+", text.lower())})
    kept = [t for t in terms if t in lexicon] or terms
    out = [spark_hash(kept) % 2**32]
    for repeat in range(imatch.REPEATS):
        rest = kept
        for level in range(imatch.LEVELS):
            rest = [t for t in rest if not t >> (repeat * imatch.LEVELS + level) & 1]
            out.append(spark_hash(rest) % 2**32 if rest else None)
    return out


def plain_likeness(a, b):
    pairs = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
    return sum(x == y for x, y in pairs) / len(pairs)


def test_fingerprints_and_likeness_by_plain_python(documents):
    """Lexicon over all documents, signatures of texts and edits, likeness from the printed fingerprints."""
    rows = sorted(((r["doc_id"], r["text"] or "") for r in documents.collect()), reverse=True)
    seen = {}
    for _, text in rows:
        for w in set(regex.findall(r"[\p{L}\p{N}]+", text.lower())):
            seen[w] = seen.get(w, 0) + 1
    low, high = max(2.0, imatch.LEAST_SHARE * len(rows)), max(2.0, imatch.MOST_SHARE * len(rows))
    lexicon = {spark_hash(w) for w, n in seen.items() if low <= n <= high}
    shown = lambda sigs: ".".join("-" if s is None else f"{s:08x}" for s in sigs)
    back = lambda text: [None if s == "-" else int(s, 16) for s in text.split(".")]
    got = {r["doc_id"]: r for r in imatch.edited_fingerprints(documents).collect()}
    for k, (i, text) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)]
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[1][:half]
        r = got[i]
        assert r["fingerprint"] == shown(plain_signatures(text, lexicon))
        assert r["edited_fingerprint"] == shown(plain_signatures(edited, lexicon))
        assert abs(r["near_edited"] - plain_likeness(back(r["fingerprint"]), back(r["edited_fingerprint"]))) < 1e-12
        assert abs(r["near_next"] - plain_likeness(back(r["fingerprint"]), back(got[follow[0]]["fingerprint"]))) < 1e-12


def test_ranges_stay_even(spark, monkeypatch):
    """Ids in bursts with wide gaps, and one id that a third of the rows have."""
    monkeypatch.setattr(imatch, "RANGE_ROWS", 5)
    monkeypatch.setattr(imatch, "CELLS", 16)
    ids = [b * 10**12 + k for b in range(10) for k in range(200)] + [77] * 1000
    df = spark.createDataFrame([(i, f"text {n}") for n, i in enumerate(ids)], "id long, text string").withColumn("tie", F.xxhash64("text"))
    rows = imatch.with_range(df, "id", "tie").collect()
    by_range = Counter(r["_range"] for r in rows)
    assert len(by_range) > 150 and max(by_range.values()) < 3 * len(rows) / 256
    ordered = sorted(rows, key=lambda r: (r["id"], r["tie"]))
    assert [r["_range"] for r in ordered] == sorted(r["_range"] for r in rows)
