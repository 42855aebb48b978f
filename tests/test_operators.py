"""Operators on hand-made cases and against plain Python."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import chunk, clean, code, dedup, generate, score, split, validate

DOC = "# Guide\n\nIntro text about agents, long enough to be kept as prose in a document of its own kind here.\n\n## How to install\n\nYou should run the steps below. " + "word " * 60 + "\n\n```python\n# comment\nimport os\nprint(os.getcwd())\n```\n\nCookie policy applies\n\nAll rights reserved 2020.\n"
FENCE = re.compile(r"```(\w*)\n(.*?)```", re.DOTALL)


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "text string").select(build(F.col("text")).alias("v")).first()["v"]


@pytest.mark.parametrize("text", ["", "  \x1f a \n", "a  \n\n\n\nb ", "x\t\ny", " é "])
def test_whitespace(spark, text):
    expected = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", text)).strip()
    assert one(spark, text, tx.normalize_whitespace) == expected


def test_hashes(spark):
    a = one(spark, "abc", tx.stable_hash)
    assert a == one(spark, "abc", tx.stable_hash) and len(a) == 16
    assert one(spark, "abc", lambda c: tx.document_id(F.lit("x"), c)).startswith("x_")


def test_unicode_and_tokens(spark):
    assert one(spark, "ﬁne", tx.normalize_unicode) == "fine"
    assert one(spark, "word " * 500, tx.count_tokens) == 650
    assert one(spark, "word " * 500, lambda c: tx.truncate_to_tokens(c, 13)).split() == ["word"] * 10
    assert one(spark, "", tx.count_tokens) == 0


def test_truncate_and_names(spark):
    assert one(spark, "a" * 30, lambda c: tx.truncate_middle(c, 10)) == "aaaaa\n...\naaaaa"
    assert one(spark, "__a b/c?.txt", tx.safe_filename) == "a_b_c_.txt"


def test_boilerplate_and_readability(spark):
    assert one(spark, "Cookie Policy\nkeep\n\n Next: ", tx.remove_boilerplate_lines) == "keep\n"
    assert 0 <= one(spark, "A short text. It reads well.", tx.readability) <= 1
    assert one(spark, "", tx.readability) == 0


@pytest.mark.parametrize("x", [139 / 800, 351 / 800, 0.01125, 0.5, 1.0, 2 / 3, 0.00005])
def test_round4(spark, x):
    assert spark.range(1).select(tx.round4(F.lit(x)).alias("v")).first()["v"] == round(x, 4)


def brute_clean(text: str) -> str:
    import unicodedata

    blocks = [(tag or "text", body.strip()) for tag, body in FENCE.findall(text)]
    marks = {f"__CODE_BLOCK_{k}__": f"```{t}\n{c}\n```" for k, (t, c) in enumerate(blocks)}
    for mark, fence in marks.items():
        text = text.replace(fence, mark, 1)
    text = re.sub("<[^>]+>", "", text)
    for entity, by in clean.ENTITIES:
        text = text.replace(entity, by)
    text = re.sub(r"&[a-zA-Z]+;|&#\d+;", "", text)
    text = re.sub(r"licensed under the .*?license.*?(?:\n\n|\Z)", "", text, flags=re.I | re.S)
    rules = [re.compile(p, re.I) for p in tx.BOILERPLATE]
    text = "\n".join(x for x in text.split("\n") if not any(r.search(x.strip()) for r in rules if x.strip()))
    text = unicodedata.normalize("NFKC", re.sub(r"\[([^\]]*)\]\(([^)]+)\)", r"\1", text))
    text = re.sub("#{7,}", "######", text)
    text = re.sub(r"^[\-\*_]{3,}\s*$", "---", text, flags=re.M)
    text = re.sub(r"^[ \t]*[•‣▪]\s+", "- ", text, flags=re.M)
    for mark, fence in marks.items():
        text = text.replace(mark, fence, 1)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", text)).strip()


PARTS = st.sampled_from([
    "# A\n", "## B c\n", "####### deep\n", "word word word. ", "\n\n", "\n", "```python\nx = 1 < 2\n```\n", "```\n pad <b>x</b> \n```\n", "```c++\nint a;\n```\n", "****\n\n", "• item\n",
    "[t](u) [x]() ", "&amp;lt; &copy; <i>q</i> ", "Licensed under the X license. ", "Cookie policy\n", "Copyright 2020\n", "ﬁ  \n",
])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PARTS, max_size=14).map("".join), min_size=6, max_size=10))
def test_clean_code_and_chunks_match_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "pos int, text string")
    got = {r["pos"]: r["text"] for r in clean.clean(df).collect()}
    expected = {k: c for k, t in enumerate(texts) if (c := brute_clean(t)).strip()}
    assert got == expected
    native = {r["pos"]: r["text"] for r in df.where("text not like '%ﬁ%'").withColumn("text", clean.clean_text("text", nfkc=False)).collect()}
    assert all(v == brute_clean(texts[k]) for k, v in native.items())
    for row in df.select("pos", code.code_blocks("text").alias("b")).collect():
        text, want = texts[row["pos"]], []
        for m in FENCE.finditer(text):
            if m[2].strip():
                want.append((m[2].strip(), text[max(0, m.start() - 300) : m.start()].strip(), text[: m.start()].count("\n") + 1))
        assert [(b["code"], b["surrounding_context"], b["line_start"]) for b in row["b"]] == want


def test_code_languages(spark):
    text = "```\nSELECT 1 FROM t\n```\n```Python\nx\n```\n```\n{}\n```\n```\nplain\n```"
    blocks = one(spark, text, code.code_blocks)
    assert [b["language"] for b in blocks] == ["sql", "python", "json", "text"]
    assert one(spark, "```a\nx\n``````b\ny\n``````b\nz\n```", lambda c: code.dominant_language(code.code_blocks(c))) == "b"


def test_chunks(spark):
    config = chunk.ChunkConfig(40, 10, 5, 80)
    df = spark.createDataFrame([("d", DOC), ("e", "")], "document_id string, text string")
    rows = chunk.chunk(df, config).orderBy("chunk_index").collect()
    assert [r["chunk_index"] for r in rows] == list(range(len(rows))) and all(r["document_id"] == "d" for r in rows)
    assert rows[-1]["heading_path"] == ["comment"]  # a comment line in code opens a section
    tail = " ".join(rows[0]["text"].split()[-7:])
    assert rows[1]["text"].startswith(tail + "\n\n")
    assert chunk.chunk(df, chunk.ChunkConfig(40, 0, 5, 80)).where("chunk_index = 1").first()["chunk_id"] == rows[1]["chunk_id"]
    with pytest.raises(ValueError):
        chunk.ChunkConfig(10, 10)


def test_oversized_section_keeps_fences():
    body = "p1 " * 30 + "\n\n```py\na\n\nb\n```\n\n" + "p2 " * 30
    out = chunk.chunks_of("# T\n\n" + body, chunk.ChunkConfig(20, 0, 5, 40))
    assert any("```py\na\n\nb\n```" in c[1] for c in out) and all(c[2] == ["T"] for c in out)


def greedy(fps, d=5):
    kept, out = {}, []
    for fp in fps:
        fp &= 2**64 - 1
        near = any((k ^ fp).bit_count() <= d for k in kept.get(fp >> 56, []))
        if not near:
            kept.setdefault(fp >> 56, []).append(fp)
        out.append(near)
    return out


def test_near_links_send_no_keys_to_the_driver(spark):
    fps = spark.range(10).select(F.col("id").alias("_fp"), F.col("id").alias("_pos"))
    plan = dedup.near_links(fps, 5)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_deduplicate_sends_no_keys_to_the_driver(spark):
    rows = spark.range(300).selectExpr("id AS pos", "sha2(string(id), 256) AS text", "string(id) AS content_hash")
    plans = []
    links = dedup.near_links
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(dedup, "near_links", lambda *a: plans.append(links(*a)) or plans[0])
        out = dedup.deduplicate(rows)
    assert out.count() == 300 and "Broadcast" not in plans[0]._jdf.queryExecution().executedPlan().toString()


def test_deduplicate_sends_no_table_of_texts_to_the_driver(spark):
    """Each of these tables is far under the broadcast threshold, as its files are at 1 GB of texts."""
    rows = spark.range(40).selectExpr("id AS pos", "concat(array_join(sequence(1, 200), ' '), ' ', id % 20) AS text", "string(id % 20) AS content_hash")
    plans = {}
    write = dedup.materialize
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(dedup, "materialize", lambda df, tag, **o: plans.setdefault(tag, []).append(df._jdf.queryExecution().sparkPlan().toString()) or write(df, tag, **o))
        out = dedup.deduplicate(rows)
    assert all("Broadcast" not in p for tag in ("simhash", "near-links", "near-dropped") for p in plans[tag])
    joins = out._jdf.queryExecution().sparkPlan().toString()
    assert joins.count("BroadcastHashJoin") == 1 and joins.count("SortMergeJoin") == 4  # the heads of 256 buckets
    assert {r["dedup_status"]: r["n"] for r in out.groupBy("dedup_status").agg(F.count("*").alias("n")).collect()}["near"] > 0


def test_near_duplicates_are_greedy(spark):
    rng = random.Random(5)
    fps = []
    for _ in range(40):
        base = rng.getrandbits(63)
        for _ in range(rng.randrange(1, 9)):
            x = base
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(56)
            fps.append(x)
            if rng.random() < 0.3:
                fps.append(x)
            base = x if rng.random() < 0.5 else base
    rng.shuffle(fps)
    df = spark.createDataFrame(list(enumerate(fps)), "pos long, simhash long").repartition(4)
    got = [r["is_near_duplicate"] for r in dedup.mark_near(df).orderBy("pos").collect()]
    assert got == greedy(fps)


def test_simhash_edges(spark):
    df = spark.createDataFrame([(0, ""), (1, "a"), (2, "a b c"), (3, "A, b - c!"), (4, "   ")], "pos long, text string")
    got = {r["pos"]: r["simhash"] for r in dedup.simhash(df).collect()}
    assert got[0] == got[4] == 0 and got[2] == got[3] != 0 and len(got) == 5


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(0, "h"), (1, "h"), (2, ""), (3, ""), (4, None)], "pos long, content_hash string")
    got = {r["pos"]: r["is_exact_duplicate"] for r in dedup.mark_exact(df).collect()}
    assert got == {0: False, 1: True, 2: False, 3: False, 4: False}


def test_filter_reasons(spark):
    df = spark.createDataFrame([(True, 5, 0.1, 0.9), (False, 5, 0.9, 0.9), (False, 50, None, 0.9), (False, 50, 0.1, 0.9), (False, 50, 0.9, 0.1), (False, 50, 0.9, 0.9)], "d boolean, t int, q double, r double")
    reason = score.rejection_reason(duplicate=F.col("d"), token_count="t", quality="q", readability="r")
    got = [r["reason"] for r in df.select(reason.alias("reason")).collect()]
    assert got == [*score.REASONS, None]


def test_generate_caps_and_ids(spark):
    df = spark.createDataFrame([("d", "d_c0", 0, DOC, 200, ["Guide", "How to install"]), ("x", "x_c0", 0, DOC, 200, ["A"])], "document_id string, chunk_id string, chunk_index int, text string, token_count int, heading_path array<string>")
    docs = spark.createDataFrame([("d", "github", "data_science", None, "u", 0.7)], "document_id string, source string, category string, framework string, url string, quality_score double")
    rows = generate.generate(df, docs, max_per_document=3).collect()
    assert [r["metadata"]["template"] for r in sorted(rows, key=lambda r: r["example_index"])] == ["qa", "instruction_following", "code_generation"]
    assert rows[0]["difficulty"] == "intermediate" and {r["metadata"]["document_id"] for r in rows} == {"d"}
    assert min(rows, key=lambda r: r["example_index"])["instruction"] == "How to install?"
    some = generate.generate(df, docs, templates=["nope", "qa"]).collect()
    assert [r["metadata"]["template"] for r in some] == ["qa"]


def test_validate(spark):
    rows = [(0, "a", "i", "", "o", "data_science", "beginner", "s"), (1, "b", "i", "", " ", "data_science", "beginner", "s"), (2, "a", "i", "", "o", "data_science", "beginner", "s")]
    df = spark.createDataFrame(rows, "pos long, id string, instruction string, input string, output string, category string, difficulty string, source string")
    out = validate.validate(df)
    assert validate.valid(out).count() == 1
    assert {r["issue_type"]: r["n"] for r in validate.issues_by_type(out).collect()} == {"missing_field": 1, "empty_output": 1, "duplicate_id": 1}
    assert validate.validation_report(out).first().asDict() == {"total_examples": 3, "valid_examples": 1, "invalid_examples": 2}
    with pytest.raises(validate.ValidationError):
        validate.validate(df, strict=True)


def test_splits(spark):
    df = spark.range(101).withColumnRenamed("id", "pos").withColumn("id", F.col("pos").cast("string"))
    assert split.train_validation(df).where("split = 'train'").count() == 90
    exact = split.train_validation_exact(df)
    order = list(range(101))
    random.Random(42).shuffle(order)
    assert {r["pos"] for r in exact.where("split = 'train'").collect()} == set(order[:90])
    assert [r["r"] for r in split.ranked(df, ["pos"], "r").orderBy("pos").collect()] == list(range(1, 102))
