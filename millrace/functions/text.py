"""Scalar text, hash and token functions as Column builders.

White space, letters and case follow the rules of ``str`` in Python, spelled out for the
JVM's regular expressions: white space is ``(?U)[\\s\\x1c-\\x1f]``, a word letter is
``[\\p{L}\\p{N}_]``, lines end at line feeds alone (``(?d)``).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"[\s\x1c-\x1f]"
_STRIP = rf"(?U)\A{_SPACE}+|{_SPACE}+\z"

#: The lines that count as boilerplate (matched on the stripped line).
BOILERPLATE = (
    r"^cookie(s)?\s+(policy|notice|consent)",
    r"^we use cookies",
    r"^subscribe to our newsletter",
    r"^all rights reserved",
    r"^copyright\s+\d{4}",
    r"^table of contents$",
    r"^skip to (main )?content",
    r"^\s*(edit this page|improve this page|was this page helpful)",
    r"^\s*(next|previous)\s*:?\s*$",
)
#: Fixed value: a fenced code block with a plain language tag.
FENCE = r"```([\p{L}\p{N}_]*)\n((?s:.*?))```"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def with_bound(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """As ``withColumns``, but each value is computed once, whatever refers to it.

    The optimizer copies an expression into all that refers to it, filters above it
    included; it does not look through a generator of one item.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    made = F.explode(F.array(F.struct(*[v.alias(n) for n, v in columns.items()]))).alias("_bound")
    out = df.select(*keep, made).select(*keep, *[F.col(f"_bound.{n}").alias(n) for n in columns])
    return out.select(*df.columns, *[n for n in columns if n not in df.columns])


def strip(text: Column | str) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(col(text), F.lit(_STRIP), F.lit(""))


def is_blank(text: Column | str) -> Column:
    """Null, empty or white space alone; the search ends at the first other letter."""
    return ~F.coalesce(col(text).rlike(rf"(?U)[^{_SPACE[1:]}"), F.lit(False))


def words(text: Column | str) -> Column:
    """Words between white space."""
    return F.filter(F.split(col(text), rf"(?U){_SPACE}+"), lambda w: w != "")


def normalize_unicode(text: Column | str) -> Column:
    """NFKC; plain ASCII texts skip the Python worker's work."""

    @F.pandas_udf("string")
    def nfkc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))

    return nfkc(col(text))


def normalize_whitespace(text: Column | str) -> Column:
    """No blanks before line ends, two line ends in a row at most, stripped."""
    no_trail = F.regexp_replace(col(text), F.lit(r"[ \t]+\n"), F.lit("\n"))
    return strip(F.regexp_replace(no_trail, F.lit(r"\n{3,}"), F.lit("\n\n")))


def strip_html_tags(text: Column | str) -> Column:
    return F.regexp_replace(col(text), F.lit("<[^>]+>"), F.lit(""))


def is_boilerplate_line(line: Column | str) -> Column:
    any_of = "(?iu)(?U)(?:" + "|".join(f"(?:{p})" for p in BOILERPLATE) + ")"
    return strip(line).rlike(any_of)


def remove_boilerplate_lines(text: Column | str) -> Column:
    return F.array_join(F.filter(F.split(col(text), "\n", -1), lambda line: ~is_boilerplate_line(line)), "\n")


def extract_code_blocks(text: Column | str) -> Column:
    """array<struct<language, code>> of all fences; without a tag the language is text."""
    tags = F.regexp_extract_all(col(text), F.lit(FENCE), F.lit(1))
    codes = F.regexp_extract_all(col(text), F.lit(FENCE), F.lit(2))
    return F.zip_with(tags, codes, lambda t, c: F.struct(F.when(t == "", "text").otherwise(t).alias("language"), strip(c).alias("code")))


def strip_code_blocks(text: Column | str) -> Column:
    return F.regexp_replace(col(text), F.lit(FENCE), F.lit(""))


def code_character_ratio(text: Column | str) -> Column:
    chars = F.aggregate(extract_code_blocks(text), F.lit(0), lambda acc, b: acc + F.length(b["code"]))
    return F.when(F.length(col(text)) == 0, 0.0).otherwise(F.least(F.lit(1.0), chars / F.greatest(F.lit(1), F.length(col(text)))))


def count_syllables(word: Column) -> Column:
    """Vowel groups, less a final e, one at least."""
    lower = F.lower(word)
    groups = F.regexp_count(lower, F.lit("[aeiouy]+"))
    return F.greatest(F.lit(1), F.when(lower.endswith("e") & (groups > 1), groups - 1).otherwise(groups))


def readability(text: Column | str) -> Column:
    """Reading ease between 0 and 1, rounded to 4 places; 0 without words or sentences."""
    prose = strip_code_blocks(text)
    sentences = F.size(F.filter(F.split(prose, "[.!?]+"), lambda s: strip(s) != ""))
    found = F.regexp_extract_all(prose, F.lit("[A-Za-z']+"), F.lit(0))

    def score(s: Column) -> Column:
        n = F.size(s["words"])
        syllables = F.aggregate(s["words"], F.lit(0), lambda acc, w: acc + count_syllables(w))
        ease = F.lit(206.835) - F.lit(1.015) * (n / s["sentences"]) - F.lit(84.6) * (syllables / n)
        return F.when((n == 0) | (s["sentences"] == 0), 0.0).otherwise(round4(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ease / 100.0))))

    # One array element binds the words, so that they are extracted once.
    return F.element_at(F.transform(F.array(F.struct(found.alias("words"), sentences.alias("sentences"))), score), 1)


def clean_markdown_links(text: Column | str, keep_link_text_only: bool = True) -> Column:
    return F.regexp_replace(col(text), F.lit(r"\[([^\]]*)\]\(([^)]+)\)"), F.lit("$1")) if keep_link_text_only else col(text)


def truncate_middle(text: Column | str, max_chars: int) -> Column:
    half = max_chars // 2
    cut = F.concat(F.left(col(text), F.lit(half)), F.lit("\n...\n"), F.right(col(text), F.lit(half)) if half else col(text))
    return F.when(F.length(col(text)) <= max_chars, col(text)).otherwise(cut)


def count_tokens(text: Column | str) -> Column:
    """1.3 for each word, rounded down: the deterministic token count."""
    return F.floor(F.size(words(text)) * 13 / 10).cast("int")


def truncate_to_tokens(text: Column | str, max_tokens: int) -> Column:
    n = int(max_tokens / 1.3)
    return F.array_join(F.slice(words(text), 1, n), " ") if n else F.lit("")


def stable_hash(text: Column | str, length: int = 16) -> Column:
    return F.left(F.sha2(col(text), 256), F.lit(length))


def document_id(source: Column, identifier: Column | str) -> Column:
    return F.concat(source, F.lit("_"), stable_hash(identifier, 12))


def normalize_for_similarity(text: Column | str, nfkc: bool = False) -> Column:
    """Lower case, single spaces, no signs. ``nfkc`` costs a Python worker; texts that
    are NFKC already (plain ASCII among them) do not need it."""
    base = normalize_unicode(text) if nfkc else col(text)
    spaced = F.regexp_replace(F.lower(base), F.lit(rf"(?U){_SPACE}+"), F.lit(" "))
    return strip(F.regexp_replace(spaced, F.lit(rf"(?U)[^\p{{L}}\p{{N}}_{_SPACE[1:]}"), F.lit("")))


def hamming_distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def simhash_similarity(a: Column, b: Column) -> Column:
    return F.lit(1.0) - hamming_distance(a, b) / F.lit(64.0)


def safe_filename(text: Column | str, max_length: int = 120) -> Column:
    safe = F.regexp_replace(col(text), F.lit(r"[^\p{L}\p{N}\-_.]"), F.lit("_"))
    return F.regexp_replace(F.left(safe, F.lit(max_length)), F.lit(r"\A_+|_+\z"), F.lit(""))


def to_prompt(instruction: Column, context: Column) -> Column:
    head = F.concat(F.lit("### Instruction:\n"), F.coalesce(instruction, F.lit("")), F.lit("\n\n"))
    given = F.when(F.coalesce(context, F.lit("")) != "", F.concat(F.lit("### Input:\n"), context, F.lit("\n\n"))).otherwise("")
    return F.concat(head, given, F.lit("### Response:\n"))


def format_for_training(instruction: Column, context: Column, output: Column, end: str = "") -> Column:
    return F.concat(to_prompt(instruction, context), F.coalesce(output, F.lit("")), F.lit(end))


def split_sentences(text: Column | str) -> Column:
    """Sentences of more than 15 letters."""
    parts = F.split(strip(text), rf"(?U)(?<=[.!?]){_SPACE}+")
    return F.filter(F.transform(parts, strip), lambda s: F.length(s) > 15)


def round4(value: Column) -> Column:
    """Rounded to 4 places by the exact binary value, ties to even, as Python's ``round``.

    ``F.round`` goes by the shortest decimal form, which makes ties of values that are
    not. The product with 10,000 and its rounding error (Dekker) tell a true tie from a
    value a little off.
    """

    def rounded(x: Column) -> Column:
        p = x * 10000.0
        c = x * 134217729.0
        high = c - (c - x)
        error = (high * 10000.0 - p) + (x - high) * 10000.0
        low = F.floor(p)
        tie = F.when(error < 0, low).when(error > 0, low + 1).otherwise(low + low % 2)
        return F.when(p - low == 0.5, tie).when(p - low > 0.5, low + 1).otherwise(low) / 10000.0

    return F.element_at(F.transform(F.array(value.cast("double")), rounded), 1)
