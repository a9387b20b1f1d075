"""Corpus-level markup operators: tokens from markup, citation counts, links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom import constants as C
from paperloom.functions.fields import is_reference_number
from paperloom.functions.markup import MarkupRules, markup_facts
from paperloom.functions.text import cleanse


def parse_documents(raw: DataFrame, rules: MarkupRules = MarkupRules(), key: str = "doc_id",
                    column: str = "xml") -> DataFrame:
    """(doc_id, text, citations, bibitems, error): one pass over the markup, no shuffle."""
    facts = raw.select(key, markup_facts(F.col(column), rules).alias("facts"))
    return facts.select(key, "facts.*")


def token_documents(parsed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Parsed documents -> normalised tokens; failed documents are left out."""
    return parsed.filter(F.col("error").isNull()).select(key, cleanse("text").alias("tokens"))


def failed_documents(parsed: DataFrame, key: str = "doc_id") -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select(key, "error")


def classify_citations(resolved: DataFrame) -> DataFrame:
    """Add `use`: parenthetical, in_text, or null where a citation is not counted."""
    textual = F.col("cite_class").isin(*C.TEXTUAL_CLASSES) & F.col("cite_key").isNotNull()
    use = (
        F.when(F.col("cite_class") == C.PARENTHETICAL_CLASS, "parenthetical")
        .when(textual & ~F.col("found"), "parenthetical")
        .when(textual & F.col("label").isNull(), None)
        .when(textual & is_reference_number("label"), "parenthetical")
        .when(textual, "in_text")
    )
    return resolved.withColumn("use", use)


def resolved_citations(parsed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Citations with the label of the first bibliography item of that key.

    Both lists stand in the document's row, so they meet there: no join, no
    shuffle, and the markup is parsed once.  The outer form of explode is on
    purpose: for the inner one Spark infers a filter that would parse again.
    `found` tells an item without a label from no item at all.
    """
    def resolve(c):
        item = F.get(F.filter("bibitems", lambda b: b["key"] == c["key"]), F.lit(0))
        return F.struct(
            c["pos"].alias("pos"), c["class"].alias("cite_class"), c["key"].alias("cite_key"),
            item["label"].alias("label"), item.isNotNull().alias("found"),
        )

    each = parsed.select(key, F.explode_outer(F.transform("citations", resolve)).alias("c"))
    return each.filter(F.col("c").isNotNull()).select(key, "c.*")


def citation_counts(parsed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Parenthetical and in-text citations of each document that cites anything."""
    resolved = resolved_citations(parsed, key)
    return classify_citations(resolved).groupBy(key).agg(
        F.count_if(F.col("use") == "parenthetical").alias("parenthetical"),
        F.count_if(F.col("use") == "in_text").alias("in_text"),
    )
