"""I-Match document fingerprints.

Terms within a band of inverse document frequency are kept, sorted and hashed; as one
hash would change with any one term, it is taken over several randomised subsets of the
lexicon, and two documents are alike to the share of the subsets on which they agree.

The lexicon holds the terms whose document frequency lies between two shares of the
corpus. Its size is bounded whatever the corpus: n documents of d distinct terms each
have at most d / least_share terms that reach the least share, so the lexicon, and only
it, goes through the driver to the executors; document frequencies are counted over all
documents. Subsets are nested: for each of ``REPEATS`` groups of hash bits, level k
keeps about a 2**-k part of the lexicon (the terms whose low k bits of the group are
zero), so that short and long texts alike have subsets of fitting size.

All steps are DataFrame expressions. Texts are shuffled once, by ranges of ids, to meet
the text that follows in descending order; ranges rest on quantiles of the ids and their
number grows with the corpus up to ``MOST_RANGES``, a bound on what is broadcast. Rows of
an id that holds more than a range's share are cut by their text's hash.

Defined results: a null text counts as empty; a text without terms of the lexicon has
the fingerprint of all its terms, so an empty one that of none; equal texts have equal
fingerprints; null ids come last in descending order; equal ids are ordered by their
text's hash; repeated rows each give a row; a single row is followed by itself; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let, materialize

TERM = r"(?U)[\p{L}\p{N}]+"
#: The band, as shares of the documents: idf between ln(1/0.25) and ln(1/0.002).
LEAST_SHARE, MOST_SHARE = 0.002, 0.25
REPEATS, LEVELS = 6, 10
#: Bits of a subset's signature, all of which are compared and printed.
SIGNATURE_BITS = 32
_SLOTS = 1 << 14
#: Ids are cut at CELLS quantiles of CELLS quantiles each.
CELLS, RANGE_ROWS, MOST_RANGES = 64, 256, 65_536


def term_hashes(text: Column) -> Column:
    """Sorted distinct 64-bit hashes of a text's terms, A-Z and other letters lowered."""
    words = F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def lexicon(docs: DataFrame, *, text: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE) -> list[int]:
    """Hashes of the terms whose document frequency is within the band."""
    hashed = docs.select(term_hashes(F.coalesce(F.col(text), F.lit(""))).alias("_t"))
    # A barrier keeps the array from being computed again for the generator's filter.
    terms = hashed.select(F.explode(F.array("_t")).alias("_t")).select(F.explode("_t").alias("_h"))
    n = docs.count()
    band = terms.groupBy("_h").agg(F.count("*").alias("_n")).where(F.col("_n").between(max(2.0, least * n), max(2.0, most * n)))
    return sorted(r["_h"] for r in band.select("_h").collect())


def _in_lexicon(words: list[int]) -> Column:
    """The lexicon as a literal table of slots: term hash modulo slots to its terms."""
    slots: list[list[int]] = [[] for _ in range(_SLOTS)]
    for h in words:
        slots[h % _SLOTS].append(h)
    # One literal for the optimizer to fold, not one for each term.
    return F.from_json(F.lit(json.dumps(slots, separators=(",", ":"))), "array<array<bigint>>")


def signatures(terms: Column, words: list[int]) -> Column:
    """array<bigint>: the signature of the kept terms of each subset, null for none."""
    table = _in_lexicon(words)
    sign = lambda of: F.xxhash64(of).bitwiseAND(F.lit((1 << SIGNATURE_BITS) - 1))
    kept = let(
        terms,
        lambda t: let(
            F.filter(t, lambda h: F.array_contains(F.element_at(table, (F.pmod(h, F.lit(_SLOTS)) + 1).cast("int")), h)),
            lambda k: F.when(F.size(k) > 0, k).otherwise(t),
        ),
    )

    def nested(of: Column, repeat: int) -> Column:
        """Signatures of the levels of one repeat, each filtered from the one before."""
        start = F.struct(of.alias("rest"), F.array().cast("array<bigint>").alias("sigs"))

        def shrink(acc: Column, k: Column) -> Column:
            bit = F.lit(1 << (repeat * LEVELS))
            mask = F.call_function("shiftleft", bit.cast("bigint"), k - 1)
            rest = F.filter(acc["rest"], lambda h: h.bitwiseAND(mask) == 0)
            return let(rest, lambda r: F.struct(r.alias("rest"), F.concat(acc["sigs"], F.array(F.when(F.size(r) > 0, sign(r)))).alias("sigs")))

        return F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), start, shrink, lambda acc: acc["sigs"])

    return let(kept, lambda k: F.concat(F.array(sign(k)), *[nested(k, r) for r in range(REPEATS)]))


def fingerprint_text(sigs: Column) -> Column:
    """Hex digits of each signature, - for a subset without terms, dot-joined."""
    return F.array_join(F.transform(sigs, lambda s: F.coalesce(F.lower(F.lpad(F.hex(s), SIGNATURE_BITS // 4, "0")), F.lit("-"))), ".")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures among the subsets on which either text has terms."""
    pair = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), F.lit(None).cast("int")).otherwise(F.when(x.eqNullSafe(y), 1).otherwise(0)))
    return let(F.filter(pair, lambda p: p.isNotNull()), lambda p: F.aggregate(p, F.lit(0), lambda acc, x: acc + x).cast("double") / F.size(p))


def with_range(rows: DataFrame, id_col: str, tie: str) -> DataFrame:
    """``rows`` with ``_range``: numbers that go down in the order of descending ids, then ``tie``.

    Ids (numbers) are dealt by their quantiles, evenly between those; an id that spans
    several quantiles is dealt by ``tie``, a long, as are null ids, which come below all.
    """
    cells = CELLS * CELLS
    at = F.percentile_approx(id_col, F.array(*[F.lit(k / cells) for k in range(cells + 1)]), F.lit(4 * cells))
    found, n = rows.agg(at, F.count("*")).first()
    wanted = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    step = max(1, cells // wanted)  # few rows need few of the quantiles
    found = [*found[:-1:step], found[-1]] if found else None
    parts = max(1, wanted // cells)
    edges = sorted(set(found or [0]))
    # An edge that stands m times holds m - 1 cells by itself: as many ranges for its ties.
    times = Counter(found or [0])
    own = [parts * max(1, times[e] - 1) for e in edges]
    first = [0, *accumulate(o + parts for o in own)]
    groups = [edges[k : k + CELLS] for k in range(0, len(edges), CELLS)]
    told = {"heads": [g[0] for g in groups], "groups": groups, "edges": edges, "own": own, "first": first[:-1]}
    kind = "struct<heads:array<{0}>,groups:array<array<{0}>>,edges:array<{0}>,own:array<int>,first:array<int>>"
    # One literal for the optimizer to fold, not one for each edge.
    table = F.from_json(F.lit(json.dumps(told)), kind.format(rows.schema[id_col].dataType.simpleString()))
    key, share = F.col(id_col), F.col(tie) / F.lit(2.0**64) + 0.5

    def cell(t: Column) -> Column:
        """How many edges are not above the id, at least 1."""
        group = F.greatest(F.size(F.filter(t["heads"], lambda e: e <= key)), F.lit(1))
        return F.greatest((group - 1) * CELLS + F.size(F.filter(F.element_at(t["groups"], group), lambda e: e <= key)), F.lit(1))

    def number(t: Column, c: Column) -> Column:
        low, high = F.element_at(t["edges"], c), F.try_element_at(t["edges"], c + 1)
        of = F.element_at(t["own"], c)
        tied = F.least(F.floor(share * of), of - 1)
        wide = high.cast("double") - low.cast("double")
        between = F.when(wide > 0, F.floor((key.cast("double") - low.cast("double")) / wide * parts)).otherwise(F.lit(0))
        inside = F.greatest(F.least(between, F.lit(parts - 1)), F.lit(0))
        return (F.element_at(t["first"], c) + F.when(key == low, tied).when(key < low, F.lit(-1)).otherwise(of + inside)).cast("int")

    nulls = F.floor(share * first[-1]) - first[-1] - 2
    numbered = let(table, lambda t: let(cell(t), lambda c: number(t, c)))
    return rows.withColumn("_range", F.when(key.isNull(), nulls).otherwise(numbered).cast("int"))


def with_guests(rows: DataFrame, id_col: str, tie: str) -> DataFrame:
    """``rows`` by ``_range``, and in each range as ``_guest`` the row that follows its last.

    Rows are in order of descending ids, then descending ``tie``. The row that follows a
    range's last is the first of the next lower range that has any; below the lowest
    comes the first of all.
    """
    ranged = with_range(rows, id_col, tie)
    # Numbers alone, of at most 2 * MOST_RANGES + 2 ranges.
    heads = ranged.groupBy("_range").agg(F.max(F.struct(id_col, tie)).alias("_top"))
    by_range = Window.orderBy(F.desc("_range"))
    host = F.coalesce(F.lag("_range").over(by_range), F.min("_range").over(Window.partitionBy()))
    hosts = materialize(heads.select(F.col("_range").alias("_r"), "_top", host.alias("_host")), "ranges", narrow=True)
    is_top = F.col(id_col).eqNullSafe(F.col("_top")[id_col]) & (F.col(tie) == F.col("_top")[tie])
    sent = ranged.join(F.broadcast(hosts), (F.col("_range") == F.col("_r")) & is_top)
    guests = sent.select(*rows.columns, F.col("_host").alias("_range"), F.lit(1).alias("_guest"))
    return ranged.withColumn("_guest", F.lit(0)).unionByName(guests)


def _signed(rows: DataFrame, words: list[int], text: str, name: str) -> DataFrame:
    return rows.withColumn(name, signatures(term_hashes(F.col(text)), words))


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE
) -> DataFrame:
    """``id_col`` and ``signatures`` of each document."""
    words = lexicon(docs, text=text, least=least, most=most)
    own = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return _signed(own, words, "_text", "signatures").drop("_text")


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """Fingerprints of each text and of its edit, and how alike they are.

    The edit replaces the last half of the code points by the first as many of the next
    document in descending order of ids (numbers).
    """
    words = lexicon(docs, text=text, least=least, most=most)
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(id_col).alias("_id"), body.alias("_text"), F.xxhash64(body).alias("_tie"))
    signed = _signed(with_guests(own, "_id", "_tie"), words, "_text", "_sigs")
    order = Window.partitionBy("_range").orderBy("_guest", F.desc_nulls_last("_id"), F.desc("_tie"))
    met = signed.withColumn("_next", F.lead(F.struct("_text", "_sigs")).over(order)).where("_guest = 0")
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    edit = F.concat(F.substring(F.col("_text"), F.lit(1), n - half), F.substring(F.col("_next._text"), F.lit(1), half))
    # The generator keeps the edit from being built once for its hash and once for its terms.
    edited = met.select("_id", n.cast("bigint").alias("n_chars"), "_sigs", F.col("_next._sigs").alias("_next_sigs"), F.explode(F.array(edit)).alias("_edit"))
    with_edit = _signed(edited, words, "_edit", "_edit_sigs")
    return with_edit.select(
        F.col("_id").alias(id_col),
        "n_chars",
        F.sha2("_edit", 256).alias("edited_sha256"),
        fingerprint_text(F.col("_sigs")).alias("fingerprint"),
        fingerprint_text(F.col("_edit_sigs")).alias("edited_fingerprint"),
        likeness(F.col("_sigs"), F.col("_edit_sigs")).alias("near_edited"),
        likeness(F.col("_sigs"), F.col("_next_sigs")).alias("near_next"),
    )
