"""Sources, sinks, configuration, the whole run and streams."""

import json
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.operators import routing
from millrace.plans import config, pipeline, queries, sinks
from millrace.sources import custom, files, html
from millrace.streaming import stateless

from .oracle import same

YAML = "project_name: p\ndirectories: {root: %(d)s/x, raw: %(d)s/x, intermediate: %(d)s/x, clean: %(d)s/x, processed: %(d)s/x, instruction: %(d)s/x, reports: %(d)s/x, logs: %(d)s/x}\nsources:\n  github_repos:\n    - {url: '%(u)s', category: data_science, framework: '${MILLRACE_FW:-none}'}\n"


def test_config(tmp_path, monkeypatch):
    at = tmp_path / "c.yaml"
    at.write_text(YAML % {"d": tmp_path, "u": "https://example.org/r"})
    assert config.load_config(at).sources.github_repos[0].framework == "none"
    monkeypatch.setenv("MILLRACE_FW", "spark")
    assert config.load_config(at).sources.github_repos[0].framework == "spark"
    over = tmp_path / "o.yaml"
    over.write_text("quality: {min_quality_score: 0.1}")
    assert config.load_config(at, over).quality.min_quality_score == 0.1
    over.write_text("chunking: {strategy: fixed}")
    with pytest.raises(config.ConfigError):
        config.load_config(at, over)
    for bad in ("project_name: x", YAML % {"d": tmp_path, "u": "ftp://x"}, "- a", "a: ${MILLRACE_NOT_SET}"):
        at.write_text(bad)
        with pytest.raises(config.ConfigError):
            config.load_config(at)
    with pytest.raises(config.ConfigError):
        config.load_config(tmp_path / "none.yaml")


def test_repository_files(spark, tmp_path):
    for path, body in {"README.md": b"# Hi \xff there", "docs/a.md": b"text", "docs/build/b.md": b"no", "docs/c.png": b"x", "docs/d.txt": b"  ", "src/m.py": b"x = 1", "docs/big.md": b"a" * 3000}.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(body)
    df = files.repository_files(spark, str(tmp_path), repo_url="https://example.org/repo.git", include_paths=["README.md", "docs"], max_file_size_kb=2, source_suffixes=[".py"])
    rows = {r["file_path"]: r for r in df.collect()}
    assert set(rows) == {"README.md", "docs/a.md", "src/m.py"}
    assert rows["README.md"]["text"] == "# Hi  there" and rows["src/m.py"]["text"] == "```py\nx = 1\n```"
    assert rows["docs/a.md"]["url"] == "https://example.org/repo/blob/main/docs/a.md"
    assert 0 < files.dir_size_mb(spark, str(tmp_path)).first()["mb"] < 0.01
    assert files.read_jsonl_or_empty(spark, str(tmp_path / "none.jsonl"), "a int").count() == 0
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert files.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int").count() == 2
    assert [r["path"].rsplit("/", 1)[1] for r in files.list_files(spark, str(tmp_path), [".py", ".png"]).collect()] == ["c.png", "m.py"]


def test_html_main_text():
    page = "<body><nav>menu</nav><main><h1>T</h1><p>a <b>b</b></p><script>x</script></main><p>out</p></body>"
    assert html.main_text(page).split() == ["T", "a", "b"]
    assert html.main_text("<p>a<br>b</p>").split() == ["a", "b"]
    assert html.main_text("<div role=main>m</div><body>x</body>") == "m"
    assert html.main_text(None) is None


def test_html_cut_references(spark):
    page = "<article><h1>a&amp;&amp</h1><p>b&lt;c &am &copy=1 &ampx; &#38; &#x26; &</p></article>"
    assert html.main_text(page).split() == ["a&&", "b<c", "&am", "©=1", "&x;", "&", "&", "&"]
    assert html.main_text(page, open_references=False).split() == ["a&&amp", "b<c", "&am", "&copy=1", "&ampx;", "&", "&", "&"]


@pytest.mark.parametrize("name", ["src11_blog_posts", "html01_main_content"])
def test_page_queries_match_sql_on_cut_references(spark, tmp_path, name):
    body = "<body><article><h1>one&amp;two&{}</h1><p>some text of twenty letters &amp; more</p></article></body>"
    rows = [(k, f"https://example.org/{k}", body.format(cut)) for k, cut in enumerate(("amp", "am", "lt", "#39", "amp;", ""))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    same(queries.QUERIES[name](spark, str(tmp_path)), con, queries.ORACLE[name])


def test_papers(spark):
    body = "x\nAbstract\nfirst\n1. Introduction\nintro\nABSTRACT\nsecond\nResults\n \n"
    df = spark.createDataFrame([("see 2305.18290v2", "T", "abs", ["A", "B"], body), ("none", "T", "", [], None)], "identifier string, title string, abstract string, authors array<string>, body string")
    row = files.paper_documents(df).first()
    assert row["text"] == "# T\n\n## Abstract\nabs\n\n## Abstract\nsecond\n\n## Introduction\nintro" and row["author"] == "A, B"


def test_papers_query_keeps_long_sections(spark, tmp_path):
    docs = spark.range(1).selectExpr("id AS doc_id", "concat(repeat('word ', 4000), 'end') AS text", "'en' AS lang", "'a' AS source", "9L AS n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert "word end" in queries.QUERIES["src14_18_papers"](spark, str(tmp_path)).first()["text"]


def test_papers_query_keeps_a_last_line_that_is_a_number(spark, tmp_path):
    """A license line that the cut at 300 letters splits leaves "0." before the next heading."""
    ends = [("x" * 273 + " licensed under CC BY-NC 4.0."), ("y" * 298 + "3."), ("z" * 300 + "\n12")]
    docs = [(3 * k, t.rjust(302, "q") if k == 0 else t, "en", "a", len(t)) for k, t in enumerate(ends)]
    assert docs[0][1][300:] == "0."
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    same(queries.QUERIES["src14_18_papers"](spark, str(tmp_path)), con, queries.ORACLE["src14_18_papers"])
    above = spark.createDataFrame([("2305.18290", "T", "", ["A"], "Abstract\na\n0.\nResults\nb")], "identifier string, title string, abstract string, authors array<string>, body string")
    assert "a\n0.\n" in files.paper_documents(above).first()["text"]
    assert "0." not in files.paper_documents(above, numbered_above=True).first()["text"]


def test_atom(spark):
    xml = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title> T </title><summary>S</summary><author><name>N</name></author><link title="pdf" href="h"/></entry></feed>'
    assert spark.createDataFrame([(xml,)], "x string").select(*files.atom_entries("x")).first() == ("T", "S", ["N"], "h")


def test_dataset_rows(spark):
    df = spark.createDataFrame([(0, " ", None), (1, "q", "a"), (2, "z", "y")], "i long, a string, b string")
    rows = files.dataset_rows(df, repo_id="o/r", index="i", max_examples=2).collect()
    assert [r["text"] for r in rows] == ["q\n\na"]


def test_dataset_rows_query_takes_all_rows(spark, tmp_path):
    docs = spark.range(2500).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "'a' AS source", "9L AS n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES["src12_dataset_rows"](spark, str(tmp_path)).count() == 2500


def test_item_source_skips_failures(spark, tmp_path):
    (tmp_path / "a").write_text("hello")
    spark.dataSource.register(custom.ItemSource)
    out = spark.read.format("millrace_items").option("items", f"{tmp_path}/a").load().collect()
    assert [r["body"] for r in out] == ["hello"]
    waits = []
    with pytest.raises(OSError):
        custom.with_retries(lambda: (_ for _ in ()).throw(OSError("x")), attempts=3, sleep=waits.append)
    assert waits == [1.0, 2.0]


def test_routing(spark):
    df = spark.createDataFrame([(0, 0, [1.0, 0.0]), (1, 0, [0.8, 0.2]), (2, 1, [0.0, 1.0])], "vec_id long, label int, embedding array<float>")
    out = routing.route(df, routing.centroids(df)).orderBy("vec_id", "rank").collect()
    assert [r["domain"] for r in out if r["rank"] == 1] == [0, 0, 1]
    assert math.isclose(sum(r["weight"] for r in out if r["vec_id"] == 0), 1)


def test_whole_run(spark, sf_dir, tmp_path):
    from millrace.plans.queries import md

    settings = pipeline.Settings()
    settings.quality.min_quality_score, settings.quality.min_readability_score = 0.6, 0.15
    settings.export.formats = ["jsonl", "parquet", "csv", "arrow", "hf_dataset"]
    docs = md(spark, sf_dir)
    stats = pipeline.run(spark, docs, str(tmp_path), settings)
    n = docs.count()
    assert stats["documents_collected"] == n and 0 < stats["documents_after_filtering"] <= n - stats["duplicates_removed"]
    made, filtered = stats["instruction_dataset"], stats["filtering"]
    assert filtered["kept"] == stats["documents_after_filtering"] and made["total_examples"] == stats["validation"]["valid_examples"]
    parts = [spark.read.json(f"{tmp_path}/export/instruction-dataset.{s}.jsonl").count() for s in ("train", "validation")]
    assert sum(parts) == made["total_examples"] and parts[0] == int(sum(parts) * 0.9)
    assert spark.read.parquet(f"{tmp_path}/export/instruction-dataset.train.parquet").count() == parts[0]
    again = pipeline.run_stage(spark, "chunk", str(tmp_path), settings)
    assert again.count() == spark.read.parquet(f"{tmp_path}/chunk").count()
    sinks.write_json(f"{tmp_path}/reports/r.json", stats)
    assert json.loads((tmp_path / "reports/r.json").read_text())["documents_collected"] == n


def test_pipeline_examples_leave_no_table_on_the_way(spark, sf_dir):
    from millrace.plans.storage import hadoop_path, shared_dir

    fs, folder = hadoop_path(spark, shared_dir(spark))
    there = lambda: {f.getPath().getName() for f in fs.listStatus(folder)}
    queries.md(spark, sf_dir)
    before = there()
    out = queries.QUERIES["gen10_pipeline_examples"](spark, sf_dir)
    assert out.count() > 0 and [n.split("-")[1] for n in there() - before] == ["ranked"]


CONFIG = """
project_name: p
directories: {{root: {d}/x, raw: {d}/x, intermediate: {d}/x, clean: {d}/x, processed: {d}/x, instruction: {d}/x, reports: {d}/x, logs: {d}/x}}
sources:
  github_repos:
    - {{url: "https://example.org/team/tool.git", category: data_science, framework: spark, include_paths: [README.md, docs], include_source: true}}
    - {{url: "https://example.org/team/gone", category: data_science}}
  documentation:
    - {{name: guide, base_url: "https://example.org/guide", urls: ["https://example.org/b", "https://example.org/a"], format: html}}
  huggingface_datasets:
    - {{repo_id: o/r, max_examples: 3, text_field: body}}
  blogs:
    - {{url: "https://blog.example.org/1", author: A}}
  papers:
    - {{identifier: "2305.18290"}}
quality: {{min_quality_score: 0.0, min_readability_score: 0.0, min_token_count: 1}}
chunking: {{min_chunk_tokens: 1}}
tokenizer: {{encoding_name: "{t}"}}
export: {{formats: [jsonl, hf_dataset], dataset_name: d, train_split: 0.5}}
"""


def test_from_configuration_to_export(spark, tmp_path):
    """YAML and a mirror in, stages, reports and a dataset folder out, all read back."""
    import pyarrow as pa
    import public_tokenizers

    mirror, out = tmp_path / "mirror", tmp_path / "out"
    words = "The index keeps every document of a corpus and the search reads it in order. " * 6
    lines = lambda *rows: "".join(json.dumps(r) + "\n" for r in rows)
    tree = {
        "github/tool/README.md": f"# Tool\n\n{words}\n\n```python\nx = 1\n```\n",
        "github/tool/docs/a.md": f"# Usage\n\nHow to use it. {words[::-1]}",
        "github/tool/src/m.py": "def f(x):\n    return x\n" * 5,
        "documentation/guide.jsonl": lines({"url": "https://example.org/a", "body": f"<main><p>page a {words}</p></main>"}, {"url": "https://example.org/b", "body": f"<main><p>other page b, {words.upper()}</p></main>"}, {"url": "https://example.org/c", "body": "<p>not listed</p>"}),
        "huggingface/o__r.jsonl": lines(*[{"row_index": k, "body": f"row {k} of the set " + chr(97 + k) * 30} for k in range(5)]),
        "blogs.jsonl": lines({"url": "https://blog.example.org/1", "body": f"<article>A post. {words[10:]}</article>"}),
        "papers.jsonl": lines({"identifier": "2305.18290", "title": "T", "abstract": "of things", "authors": ["B"], "body": "Introduction\nSome intro of the paper."}),
    }
    for path, body in tree.items():
        (mirror / path).parent.mkdir(parents=True, exist_ok=True)
        (mirror / path).write_text(body)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    (tmp_path / "c.yaml").write_text(CONFIG.format(d=tmp_path, t=ranks))
    conf = config.load_config(tmp_path / "c.yaml")
    report = pipeline.run_config(spark, conf, f"file://{mirror}", f"file://{out}")
    raw = spark.read.parquet(f"{out}/collect").orderBy("pos").collect()
    assert [r["pos"] for r in raw] == list(range(len(raw)))
    assert [r["source"] for r in raw] == ["github"] * 3 + ["documentation"] * 2 + ["huggingface"] * 3 + ["blog", "paper"]
    assert [r["file_path"] for r in raw[:3]] == ["README.md", "docs/a.md", "src/m.py"] and raw[3]["url"].endswith("/b")
    # The configured vocabulary counts the tokens of documents and chunks.
    from millrace.functions import tokens

    status = spark.read.parquet(f"{out}/clean").collect()
    assert all(r["token_count"] == tokens.count(r["text"], ranks) for r in status)
    assert any(r["token_count"] != len(r["text"].split()) * 13 // 10 for r in status)
    assert all(r["token_count"] == tokens.count(r["text"], ranks) for r in spark.read.parquet(f"{out}/chunk").collect())
    for name in ("filter_report", "validation_report", "dataset_statistics"):
        assert json.loads((out / f"reports/{name}.json").read_text())
    assert json.loads((out / "reports/dataset_statistics.json").read_text())["documents_collected"] == len(raw) == report["documents_collected"]
    folder = out / "export" / "d_hf"
    assert json.loads((folder / "dataset_dict.json").read_text()) == {"splits": ["train", "validation"]}
    n = 0
    for part in ("train", "validation"):
        state, info = (json.loads((folder / part / f"{x}.json").read_text()) for x in ("state", "dataset_info"))
        with pa.memory_map(str(folder / part / state["_data_files"][0]["filename"])) as f:
            table = pa.ipc.open_stream(f).read_all()
        assert set(info["features"]) == set(table.column_names) and info["features"]["instruction"] == {"dtype": "string", "_type": "Value"}
        assert isinstance(info["features"]["metadata"], dict) and "template" in info["features"]["metadata"]
        lines_of = spark.read.json(f"file://{out}/export/d.{part}.jsonl")
        assert lines_of.count() == table.num_rows
        n += table.num_rows
    assert n == report["instruction_dataset"]["total_examples"] > 0
    assert pipeline.run_stage(spark, "export", f"file://{out}", config=conf).count() == n
    with pytest.raises(ValueError):
        pipeline.run_stage(spark, "collect", f"file://{out}")
    none = config.Sources(blogs=[config.Blog(url="https://x")])
    from millrace.sources.collect import collect

    assert collect(spark, none, f"file://{tmp_path}/none").count() == 0


def test_laid_over_layers():
    assert config.laid_over([{"a": {"b": 1, "c": {"d": 2}}, "e": [1]}, {"a": {"c": {"d": 3}}, "e": {"k": 1}}, {"a": {}}]) == {"a": {"b": 1, "c": {"d": 3}}, "e": {"k": 1}}
    assert config.laid_over([{"a": {"b": 1}}, {"a": 5}]) == {"a": 5}
    assert config.resolved("${X:-b} ${Y:c}${Z:} ${1x} ${A${X:q}", {"Y": "y"}) == "b y ${1x} ${Aq"


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("ts", F.timestamp_seconds(F.col("doc_id") + 1_000_000_000))
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = stateless.prepare(stateless.read_documents(spark, str(tmp_path / "in"), docs.schema, 1))
    q = stream.writeStream.format("memory").queryName("prepared").trigger(availableNow=True).start()
    q.awaitTermination(120)
    cols = ["doc_id", "text", "quality_score", "reason"]
    assert sorted(map(str, spark.table("prepared").select(*cols).collect())) == sorted(map(str, stateless.prepare(docs).select(*cols).collect()))
    first = stateless.first_sightings(stateless.read_documents(spark, str(tmp_path / "in"), docs.schema), time="ts", delay="10 days")
    q = first.writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("firsts").count() == docs.select("text").distinct().count()


def test_encoded_tokens(spark):
    import public_tokenizers

    from millrace.functions import tokens

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    df = spark.createDataFrame([("hello world again",), ("",), (None,)], "t string")
    row = df.select(tokens.count_encoded("t", path).alias("n"), tokens.truncate_encoded("t", 2, path).alias("cut"), tokens.count_encoded("t", "/no/such/file").alias("fallback")).collect()
    assert [r["n"] for r in row] == [3, 0, 0] and row[0]["cut"] == "hello world" and row[0]["fallback"] == 3


def test_logging(tmp_path):
    from millrace.plans import logs

    logs.configure_logging(str(tmp_path), as_json=True)
    logs.get_logger("x").info("done %d", 3)
    logs.configure_logging()
    assert json.loads((tmp_path / "pipeline.log").read_text())["message"] == "done 3"
