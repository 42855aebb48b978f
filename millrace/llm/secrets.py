"""Secret scan by corpus-wide ownership frequency.

Every text is searched once for candidate credentials. The hash of each candidate is
then counted over the whole corpus by distinct owner and distinct repository: a value
that many owners hold is a widely copied example (``copied``). A value that looks random
and that one owner alone holds is taken as a live credential (``live``) if it stands in
one of the owner's repositories, and as what the owner copies from one to the other
(``template``) if in several. All else is ``shared``. Beside the three base kinds
(``assign``, ``access``, ``hex``) the ownership counts add two kinds of span:

* ``leak``: a long random-looking run, of no base kind here, whose value is a base
  candidate elsewhere in the corpus;
* ``owned``: a long random-looking run that one owner alone holds.

All steps are DataFrame expressions. Texts are read once and never shuffled; only the
hits are, and counts are aggregated before each exchange by (hash, owner, repository),
then (hash, owner), then hash, so that no task gathers the holders of a common value.

Defined results: a null text counts as empty and has no hit; null owners or
repositories form one owner or repository of their own; repeated rows and repeated ids
each give a row; an empty table gives an empty result; columns other than those named
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_few_parts, let, materialize, packed, running_sums

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "leak", "owned")

#: Fixed patterns of the base kinds, with the least length of what must be long.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = "AKIA[A-Z0-9]{14,}"  # greedy runs of 18 or more: a shorter run has no longer part
HEX = "[0-9a-f]{16,}"
RUN = "[A-Za-z0-9+/_=-]{20,}"
#: Words of placeholder values.
PLACEHOLDER = "(?i)(example|changeme|placeholder|sample|dummy|xxxx|0000|1234)"

_HIT = "struct<start:bigint,end:bigint,rank:int,digest:string,live:boolean>"


def looks_live(value: Column) -> Column:
    """Whether a value looks random: digits and letters, varied, no placeholder word."""
    varied = F.size(F.array_distinct(F.split(value, ""))) >= 9
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(PLACEHOLDER) & varied


def _hits(text: Column, pattern: str, rank: int, keep=None, value=lambda hit: hit) -> Column:
    """Array of ``_HIT`` for the leftmost non-overlapping matches that ``keep`` takes."""

    def place(found: Column) -> Column:
        # The texts between the matches give their places, in code points.
        ends = running_sums(F.zip_with(F.split(text, pattern, -1), found, lambda gap, hit: F.length(gap) + F.coalesce(F.length(hit), F.lit(0))))
        return let(
            ends,
            lambda e: F.transform(
                found,
                lambda hit, i: F.struct(
                    (F.element_at(e, i + 1) - F.length(hit)).cast("bigint").alias("start"),
                    F.element_at(e, i + 1).cast("bigint").alias("end"),
                    F.lit(rank).alias("rank"),
                    value(hit).alias("value"),
                ),
            ),
        )

    placed = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, place(found)).otherwise(
            F.array().cast("array<struct<start:bigint,end:bigint,rank:int,value:string>>")
        ),
    )
    if keep is not None:
        placed = F.filter(placed, lambda h: keep(h["value"]))
    return F.transform(
        placed,
        lambda h: F.struct(
            h["start"].alias("start"),
            h["end"].alias("end"),
            h["rank"].alias("rank"),
            F.sha2(h["value"], 256).alias("digest"),
            looks_live(h["value"]).alias("live"),
        ),
    ).cast(f"array<{_HIT}>")


def scan(docs: DataFrame, keys: list[Column], *, text: str, owner: str, repository: str) -> DataFrame:
    """Rows of ``keys``, ``_row``, ``_owner``, ``_repository``, ``_hits``, written once."""
    body = F.coalesce(F.col(text), F.lit(""))
    group2 = lambda hit: F.regexp_extract(hit, ASSIGN, 2)
    base = F.concat(
        _hits(body, ASSIGN, 0, lambda v: F.length(v) >= ASSIGN_LEAST, group2),
        _hits(body, ACCESS, 1),
        _hits(body, HEX, 2),
    )
    runs = _hits(body, RUN, 3, looks_live)
    found = docs.select(
        *keys,
        F.col(owner).alias("_owner"),
        F.col(repository).alias("_repository"),
        F.monotonically_increasing_id().alias("_row"),
        let(
            F.struct(base.alias("base"), runs.alias("runs")),
            lambda s: F.concat(
                s["base"],
                F.filter(s["runs"], lambda r: ~F.exists(s["base"], lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))),
            ),
        ).alias("_hits"),
    )
    return materialize(found, "secret-hits")


def ownership(found: DataFrame) -> DataFrame:
    """For each candidate hash: its documents' hits, distinct repositories and owners.

    A repository belongs to its owner: two owners' repositories of one name are two.
    """
    occ = found.select("_owner", "_repository", F.explode("_hits").alias("h"))
    return (
        occ.groupBy(F.col("h.digest").alias("digest"), "_owner", "_repository")
        .agg(F.count("*").alias("n"), F.max(F.col("h.rank") < 3).alias("base"))
        .groupBy("digest", "_owner")
        .agg(F.count("*").alias("repositories"), F.sum("n").alias("n"), F.max("base").alias("base"))
        .groupBy("digest")
        .agg(
            F.count("*").alias("owners"),
            F.sum("repositories").alias("repositories"),
            F.sum("n").alias("hits"),
            F.max("base").alias("base"),
        )
    )


def classified(found: DataFrame, copied_owners: int = 3) -> DataFrame:
    """``_row`` and its sorted ``spans``: start, rank, end, verdict.

    verdict: ``copied`` for a value with at least ``copied_owners`` owners; for one of a
    single owner that looks random ``live`` in one repository and ``template`` in several;
    ``shared`` for the rest. Runs that are neither a leak nor owned are not spans.
    """
    occ = found.select("_row", F.explode("_hits").alias("h")).select("_row", "h.*")
    held = occ.join(ownership(found), "digest")
    verdict = (
        F.when(F.col("owners") >= copied_owners, "copied")
        .when((F.col("owners") == 1) & F.col("live"), F.when(F.col("repositories") == 1, "live").otherwise("template"))
        .otherwise("shared")
    )
    rank = (
        F.when(F.col("rank") < 3, F.col("rank"))
        .when(F.col("base"), F.lit(3))
        .when(F.col("owners") == 1, F.lit(4))
    )
    return (
        held.select("_row", "start", rank.alias("rank"), "end", verdict.alias("verdict"))
        .where("rank is not null")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end", "verdict"))).alias("spans"))
    )


def find_secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "source",
    copied_owners: int = 3,
) -> DataFrame:
    """One row per document: ``id_col`` and ``spans`` (start, rank in KINDS, end, verdict)."""
    found = scan(docs, [F.col(id_col).alias("_id")], text=text, owner=owner, repository=repository)
    spans = classified(found, copied_owners)
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,verdict:string>>")
    return in_few_parts(found.select("_row", "_id").join(spans, "_row", "left")).select(
        F.col("_id").alias(id_col), F.coalesce("spans", empty).alias("spans")
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def secret_digests(docs: DataFrame, **options) -> DataFrame:
    """The digest columns of ``find_secrets``: counts and joined spans."""
    spans = F.col("spans")
    of = lambda rank: F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("bigint")
    with_verdict = lambda v: F.size(F.filter(spans, lambda s: s["verdict"] == v)).cast("bigint")
    return find_secrets(docs, **options).select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(span_text(F.filter(spans, lambda s: s["rank"] < 3)), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
        with_verdict("live").alias("n_live"),
        with_verdict("template").alias("n_template"),
        with_verdict("copied").alias("n_copied"),
    )


def redact(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "source",
    copied_owners: int = 3,
    mark: str = "[SECRET]",
) -> DataFrame:
    """``docs`` with each span that is no widely copied example replaced by ``mark``.

    Overlapping spans are replaced together. Rows, their other columns and null texts
    stay as they are; ``n_chars``, where present, follows the text.
    """
    keys = [F.col(id_col).alias("_id"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("_text")]
    found = scan(docs, keys, text=text, owner=owner, repository=repository)
    # Equal texts under one id have equal spans: one of them suffices.
    bad = classified(found, copied_owners).select("_row", F.filter("spans", lambda s: s["verdict"] != "copied").alias("_spans"))
    by_key = found.select("_row", "_id", "_text").join(bad.where(F.size("_spans") > 0), "_row").groupBy("_id", "_text").agg(F.first("_spans").alias("_spans"))

    body = F.col("_body")
    # Cut the text at the edges of merged spans; gaps keep their text.
    merged = F.aggregate(
        "_spans",
        F.array().cast("array<struct<a:bigint,b:bigint>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["b"] > s["start"]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(F.try_element_at(acc, F.lit(-1))["a"].alias("a"), F.greatest(F.try_element_at(acc, F.lit(-1))["b"], s["end"]).alias("b"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("a"), s["end"].alias("b"))))),
    )

    def rebuilt(m: Column) -> Column:
        before = F.transform(m, lambda s, i: F.substring(body, (F.coalesce(F.try_element_at(m, F.nullif(i, F.lit(0)))["b"], F.lit(0)) + 1).cast("int"), (s["a"] - F.coalesce(F.try_element_at(m, F.nullif(i, F.lit(0)))["b"], F.lit(0))).cast("int")))
        tail = F.substring(body, (F.element_at(m, -1)["b"] + 1).cast("int"), F.length(body))
        return F.concat(F.array_join(F.transform(before, lambda p: F.concat(p, F.lit(mark))), ""), tail)

    rows = docs.select(packed(docs).alias("_doc"), F.col(id_col).alias("_id"), F.col(text).alias("_body"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("_text"))
    rows, by_key = rows.alias("d"), by_key.alias("k")
    joined = rows.join(by_key, F.col("d._id").eqNullSafe(F.col("k._id")) & (F.col("d._text") == F.col("k._text")), "left")
    new = F.when(F.col("_spans").isNull(), body).otherwise(let(merged, rebuilt))
    cleaned = joined.select("_doc", new.alias("_new"), F.col("_spans").isNotNull().alias("_changed"))

    def column(name: str) -> Column:
        old = F.col(f"_doc.`{name}`")
        if name == text:
            return F.col("_new").alias(name)
        if name == "n_chars":
            return F.when(F.col("_changed"), F.length("_new")).otherwise(old).cast(docs.schema[name].dataType).alias(name)
        return old.alias(name)

    return cleaned.select(*map(column, docs.columns))
