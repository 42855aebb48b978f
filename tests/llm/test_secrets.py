"""op1 against patterns of Python's re."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.llm import queries, secrets
from tests.oracle import database, same

from .conftest import MESSY


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text, re.ASCII) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def joined(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check(rows):
    for text, row in rows:
        spans = base_spans(text or "")
        assert row["base_sha256"] == hashlib.sha256(joined(spans).encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert set(filter(None, joined(spans).split(","))) <= set(row["spans"].split(","))


def test_messy(spark, messy):
    got = secrets.secret_digests(messy).collect()
    assert len(got) == len(MESSY)
    by_id = defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    check((t, by_id[i].pop()) for i, t, *_ in MESSY)


def test_documents(documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    check((texts[r["doc_id"]], r) for r in secrets.secret_digests(documents).collect())


def test_empty(no_docs):
    assert secrets.secret_digests(no_docs).count() == 0 and secrets.redact(no_docs).count() == 0


def test_many_hits_in_one_text(spark):
    text = " x ".join(f"{k:016x}" for k in range(3000))
    df = spark.createDataFrame([(1, text, "a", "s")], "doc_id long, text string, lang string, source string")
    check([(text, secrets.secret_digests(df).first())])


def test_ownership_tells_examples_from_live_values(spark):
    copied, live, run = "password=Abc123Def456xyz", "password=Zyx987Wvu654abc", "Qw3rTy7uIoP9aSdF2gHjK4"
    rows = [(k, f"see {copied}", f"o{k}") for k in range(4)] + [(10, f"my {live} and {run}", "o9"), (11, "bare Zyx987Wvu654abcXXXXXX", "o1"), (12, "bare " + "Zz9" + "Abc123Def456xyzQQQQQQQQ", "o2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in secrets.find_secrets(df).collect()}
    assert [s["verdict"] for s in got[0]["spans"]] == ["copied"]
    assert [(s["rank"], s["verdict"]) for s in got[10]["spans"]] == [(0, "live"), (4, "live")]
    out = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert out[0] == f"see {copied}" and out[10] == "my [SECRET] and [SECRET]"


def test_leak_of_a_value_found_elsewhere(spark):
    value = "Zyx987Wvu654abcQr5Ts"
    rows = [(1, f"token: {value}", "a"), (2, f"bare {value} here", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["spans"] for r in secrets.secret_digests(df).collect()}
    assert got[2] == f"leak:5:{5 + len(value)}"


def test_redact_keeps_rows_and_merges_overlaps(spark, messy):
    out = secrets.redact(messy)
    assert out.columns == messy.columns and out.count() == messy.count()
    assert "[SECRET]" in out.where("doc_id = 12").first()["text"] and out.where("doc_id = 4").first()["text"] is None
    bad = out.where(F.length("text") != F.col("n_chars")).where("text is not null")
    assert bad.count() == 0


def test_sql(spark, sf_dir):
    name = "op1_secret_ownership"
    same(queries.QUERIES[name](spark, sf_dir), database(sf_dir), queries.ORACLE[name])
