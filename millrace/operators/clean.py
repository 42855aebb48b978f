"""Document cleaning: an ordered chain over prose with code protected.

A fence is protected only if it stands in the text just as it would be written back
(tag or ``text``, stripped code); the others are cleaned as prose. Protected fences are
swapped for placeholders one by one, first occurrence first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import tokens

#: Fixed value: the licence block, up to a blank line or the end.
LICENSE_BLOCK = r"(?isu)licensed under the .*?license.*?(?:\n\n|\z)"
#: Entities in the order in which they are replaced.
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&apos;", "'"))


def replace_first(text: Column, what: Column, by: Column) -> Column:
    at = F.call_function("locate", what, text)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), by, F.substring(text, at + F.length(what), F.length(text)))).otherwise(text)


def remove_html_artifacts(text: Column | str) -> Column:
    """Tags go first, then entities in order, then what entities are left."""
    out = tx.strip_html_tags(text)
    for entity, by in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(by))
    return F.regexp_replace(out, F.lit(r"&[a-zA-Z]+;|&#\d+;"), F.lit(""))


def remove_license_blocks(text: Column | str) -> Column:
    return F.regexp_replace(tx.col(text), F.lit(LICENSE_BLOCK), F.lit(""))


def normalize_markdown_structure(text: Column | str) -> Column:
    out = F.regexp_replace(tx.col(text), F.lit("#{7,}"), F.lit("######"))
    out = F.regexp_replace(out, F.lit(r"(?md)(?U)^[\-\*_]{3,}[\s\x1c-\x1f]*$"), F.lit("---"))
    return F.regexp_replace(out, F.lit(r"(?md)(?U)^[ \t]*[•‣▪][\s\x1c-\x1f]+"), F.lit("- "))


def _fenced(block: Column) -> Column:
    return F.concat(F.lit("```"), block["language"], F.lit("\n"), block["code"], F.lit("\n```"))


def _marked(fences: Column) -> Column:
    return F.transform(fences, lambda f, i: F.struct(f.alias("fence"), F.concat(F.lit("__CODE_BLOCK_"), i.cast("string"), F.lit("__")).alias("mark")))


def clean_text(text: Column | str, nfkc: bool = True) -> Column:
    """The whole chain. ``nfkc=False`` keeps it free of Python where texts are NFKC."""
    raw = tx.col(text)
    fences = _marked(F.transform(tx.extract_code_blocks(raw), _fenced))

    def prose(protected: Column) -> Column:
        out = remove_license_blocks(remove_html_artifacts(protected))
        return tx.clean_markdown_links(tx.remove_boilerplate_lines(out))

    # Fences without which there is nothing to protect are bound once.
    def whole(pair: Column) -> Column:
        protected = F.aggregate(pair["fences"], pair["text"], lambda acc, b: replace_first(acc, b["fence"], b["mark"]))
        return F.struct(pair["fences"].alias("fences"), prose(protected).alias("text"))

    bound = F.element_at(F.transform(F.array(F.struct(fences.alias("fences"), raw.alias("text"))), whole), 1)

    def finish(s: Column) -> Column:
        out = F.aggregate(s["fences"], normalize_markdown_structure(s["text"]), lambda acc, b: replace_first(acc, b["mark"], b["fence"]))
        return tx.normalize_whitespace(out)

    if not nfkc:
        return F.element_at(F.transform(F.array(bound), finish), 1)
    normal = F.struct(bound["fences"].alias("fences"), tx.normalize_unicode(bound["text"]).alias("text"))
    return F.element_at(F.transform(F.array(normal), finish), 1)


def clean(docs: DataFrame, *, text: str = "text", nfkc: bool = True) -> DataFrame:
    """``docs`` with cleaned texts; those that come out blank are dropped."""
    if not nfkc:
        return tx.with_bound(docs, {text: clean_text(text, nfkc=False)}).where(tx.strip(text) != "")
    raw = F.col(text)
    fences = _marked(F.transform(tx.extract_code_blocks(raw), _fenced))
    step = tx.with_bound(docs, {"_fences": fences})
    protected = F.aggregate("_fences", raw, lambda acc, b: replace_first(acc, b["fence"], b["mark"]))
    out = tx.clean_markdown_links(tx.remove_boilerplate_lines(remove_license_blocks(remove_html_artifacts(protected))))
    step = step.withColumn("_prose", tx.normalize_unicode(out))
    final = tx.normalize_whitespace(F.aggregate("_fences", normalize_markdown_structure("_prose"), lambda acc, b: replace_first(acc, b["mark"], b["fence"])))
    return tx.with_bound(step, {text: final}).drop("_fences", "_prose").where(tx.strip(text) != "")


def enrich(docs: DataFrame, *, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Length, token count (by ``tokenizer``, if given) and content hash of each text."""
    out = tx.with_bound(docs, {"document_length_chars": F.length(text), "token_count": tx.count_tokens(text), "content_hash": tx.stable_hash(text)})
    return out.withColumn("token_count", tokens.count_encoded(text, tokenizer)) if tokenizer else out
