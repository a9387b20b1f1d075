"""Noun lemmas by table lookup.

A lexicon of nouns (column `word`) and a table of irregular forms
(`word`, `lemma`) are inputs; forms come from the published ending rules.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paperloom.functions.text import noun_rule_candidates
from paperloom.operators.skew import fits_broadcast, lookup
from paperloom.operators.word_codes import TABLE_BYTES, TABLE_ROWS, WordTable, coded


def lemma_table(words: DataFrame, lexicon: DataFrame, irregular: DataFrame | None = None) -> DataFrame:
    """(word, lemma) for each distinct word that has a lemma other than itself.

    A word with irregular forms uses those instead of the rules.  Of the forms
    the lexicon knows the shortest is taken, the first one on a tie.
    """
    distinct = words.select("word").distinct()
    if irregular is None:
        regular, odd = distinct, None
    else:
        regular = distinct.join(irregular.select("word"), "word", "left_anti")
        odd = distinct.join(irregular.select("word", F.col("lemma").alias("form")), "word")
        itself = odd.select("word", F.col("word").alias("form")).distinct()
        odd = itself.withColumn("at", F.lit(0)).unionByName(odd.withColumn("at", F.lit(1)))
    forms = regular.select("word", F.posexplode(noun_rule_candidates("word")).alias("at", "c")).select(
        "word", "at", F.col("c.round").alias("round"), F.col("c.form").alias("form")
    )
    if odd is not None:
        forms = forms.unionByName(odd.withColumn("round", F.lit(1)))
    known = forms.join(lexicon.select(F.col("word").alias("form")), "form", "left_semi")
    rank = F.struct("round", F.length("form"), "at", F.col("form").alias("lemma"))
    best = known.groupBy("word").agg(F.min(rank).alias("best"))
    return best.select("word", F.col("best.lemma").alias("lemma")).filter("word <> lemma")


class LemmaTable:
    """Words and their lemmas, as every task holds them."""

    def __init__(self, words: pa.Array, lemmas: pa.Array):
        whole = pa.array(words.is_valid().to_numpy(zero_copy_only=False) & lemmas.is_valid().to_numpy(zero_copy_only=False))
        words, lemmas = words.filter(whole), lemmas.filter(whole)
        self.table = WordTable(words)
        self.lemmas = lemmas.take(pa.array(np.argsort(self.table.places(words))))

    def replaced(self, names: pa.Array) -> pa.Array:
        """The lemma of each word that has one, else the word."""
        if not len(self.lemmas):
            return names
        at = self.table.places(names)
        return pc.if_else(pa.array(at >= 0), self.lemmas.take(pa.array(np.maximum(at, 0))), names)


def _replacing(table):
    """A function of token arrays that replaces the words of `table`."""
    @F.arrow_udf("array<string>")
    def replaced(lists: pa.Array) -> pa.Array:
        names, place, lengths = coded(lists)
        words = pa.concat_arrays([table.value.replaced(names), pa.nulls(1, names.type)]).take(pa.array(place))
        offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), words, mask=lists.is_null())

    return replaced.asNondeterministic()  # else a filter on the result would have it made twice


def lemmatise(tokens: DataFrame, lemmas: DataFrame, key: str = "doc_id", column: str = "tokens") -> DataFrame:
    """Replace the tokens that have a lemma.

    `lemmas` should be a stored table, as its size is looked at.  It is sent to
    every task, and words are replaced where they are read; beyond some millions
    of lemmas the words are joined to it.  Rows without a key are left alone.
    """
    pairs = lemmas.select("word", "lemma")
    if not fits_broadcast(pairs, TABLE_ROWS, TABLE_BYTES):
        return _lemmatise_joined(tokens, lemmas, key, column)
    found = pairs.toArrow()
    sides = [found[c].cast(pa.string()).combine_chunks() for c in ("word", "lemma")]
    table = tokens.sparkSession.sparkContext.broadcast(LemmaTable(*sides))
    replaced = F.when(F.col(key).isNotNull(), _replacing(table)(F.col(column))).otherwise(F.col(column))
    return tokens.select(key, *(c for c in tokens.columns if c != key)).withColumn(column, replaced)


def _lemmatise_joined(tokens: DataFrame, lemmas: DataFrame, key: str, column: str) -> DataFrame:
    """`lemmatise` for a table of any size.

    Only the distinct words of a document travel to the lookup; they come back
    as one small map per document, applied in place, so token arrays keep their
    order and are never rebuilt from rows.
    """
    words = tokens.select(key, F.explode_outer(F.array_distinct(column)).alias("word")).filter(F.col("word").isNotNull())
    found = lookup(words, lemmas, "word", [key])
    maps = found.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "lemma"))).alias("_lemmas")
    )
    replaced = F.transform(
        column, lambda w: F.coalesce(F.try_element_at(F.col("_lemmas"), w), w)
    )
    return tokens.join(maps, key, "left").withColumn(column, replaced).drop("_lemmas")
