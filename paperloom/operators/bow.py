"""Dictionaries, bags of words and term counts over `tokens(doc_id, tokens)`."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paperloom.memory import released
from paperloom.operators.indexing import dense_index
from paperloom.operators.skew import BROADCAST_BYTES, BROADCAST_ROWS, MOST_HEAVY, TASK_ROWS, fits_broadcast, salted_lookup
from paperloom.session import staged

# Rows of a batch of counts.
COUNT_ROWS = 1 << 16


def each_token(tokens: DataFrame, *keys: str, column: str = "tokens") -> DataFrame:
    """One row per token.

    The outer form is on purpose: for the inner one Spark infers a filter on the
    array, and would tokenise a document twice if the array is not stored.
    """
    each = tokens.select(*keys, F.explode_outer(column).alias("token"))
    return each.filter(F.col("token").isNotNull())


def _counting(ordered: bool):
    """A function of Arrow batches (key, tokens) -> (key, token, cnt) of each row, ascending by (cnt, token) if `ordered`."""
    def run(batches):
        for batch in batches:
            keys, lists = batch.column(0), batch.column(1)
            words, of = lists.flatten(), pc.list_parent_indices(lists)
            if words.null_count:
                of, words = of.filter(words.is_valid()), words.drop_null()
            coded = words.dictionary_encode()
            names = coded.dictionary
            if not len(names):
                continue
            place = of.to_numpy(zero_copy_only=False).astype(np.int64) * len(names) + coded.indices.to_numpy(zero_copy_only=False)
            found, cnt = np.unique(place, return_counts=True)
            row, code = np.divmod(found, len(names))
            if ordered:
                rank = np.empty(len(names), np.int64)
                rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
                by = np.lexsort((rank[code], cnt, row))
                row, code, cnt = row[by], code[by], cnt[by]
            for k in range(0, len(row), COUNT_ROWS):
                part = slice(k, k + COUNT_ROWS)
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(row[part])), names.take(pa.array(code[part])), pa.array(cnt[part])],
                                                 [batch.schema.names[0], "token", "cnt"])

    return released(run)


def _counts_by_row(tokens: DataFrame, key: str, column: str, ordered: bool) -> tuple[DataFrame, DataFrame | None]:
    """Counts of the rows whose key no other row has, which are final, and of all other rows, to be added up by key and token."""
    kind = tokens.schema[key].dataType.simpleString()

    def counted(rows, ordered=False):
        return rows.select(key, column).mapInArrow(_counting(ordered), f"`{key}` {kind}, token string, cnt bigint")

    repeated = staged(tokens.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n")).filter("n > 1").select("_key"), "repeated-keys")
    if repeated.isEmpty():
        return counted(tokens, ordered), None
    if not fits_broadcast(repeated):
        return counted(tokens.limit(0)), counted(tokens)
    again, same = F.broadcast(repeated), F.col(key).eqNullSafe(F.col("_key"))
    return counted(tokens.join(again, same, "left_anti"), ordered), counted(tokens.join(again, same, "left_semi"))


def _added(counts: DataFrame, key: str) -> DataFrame:
    return counts.groupBy(key, "token").agg(F.sum("cnt").alias("cnt"))


def term_counts(tokens: DataFrame, key: str = "doc_id", column: str = "tokens") -> DataFrame:
    """(document, token, cnt).

    A row's words are counted where the row is read.  Only counts of documents that stand in several rows are shuffled.
    """
    final, parts = _counts_by_row(tokens, key, column, False)
    return final if parts is None else final.unionByName(_added(parts, key))


def sorted_term_counts(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Token counts of each document, ascending by (count, token) within it."""
    final, parts = _counts_by_row(tokens, key, "tokens", True)
    if parts is None:
        return final
    ordered = _added(parts, key).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("cnt", "token"))).alias("terms"))
    return final.unionByName(ordered.select(key, F.explode_outer("terms").alias("t")).select(key, "t.token", "t.cnt"))


def corpus_counts(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """Occurrences of every token in the corpus."""
    each = each_token(tokens, column=column)
    return each.groupBy("token").agg(F.count("*").alias("cnt"))


def frequent_terms(tokens: DataFrame, min_count: int = 5, column: str = "tokens") -> DataFrame:
    """Tokens that occur at least `min_count` times."""
    return corpus_counts(tokens, column).filter(F.col("cnt") >= min_count)


def vocabulary_size(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """Number of different tokens."""
    return corpus_counts(tokens, column).agg(F.count("*").alias("terms"))


def term_statistics(counts: DataFrame) -> DataFrame:
    """Per token: documents that have it, and occurrences."""
    return counts.groupBy("token").agg(
        F.count("*").alias("doc_freq"), F.sum("cnt").alias("term_freq")
    )


def vocabulary(counts: DataFrame) -> DataFrame:
    """Dictionary (term_id, term, doc_freq, term_freq); ids follow the term order."""
    terms = term_statistics(counts).withColumnRenamed("token", "term")
    return dense_index(terms, ["term"], "term_id").select("term_id", "term", "doc_freq", "term_freq")


def _common_floor(vocab: DataFrame) -> int:
    """A document frequency that so few terms exceed that these may be broadcast."""
    size = F.sum(F.octet_length("term") + 48)
    steps = vocab.groupBy("doc_freq").agg(F.count("*").alias("n"), size.alias("size")).orderBy(F.desc("doc_freq")).toLocalIterator()
    rows = held = 0
    for step in steps:
        rows, held = rows + step.n, held + step["size"]
        if rows > BROADCAST_ROWS or held > BROADCAST_BYTES:
            return step.doc_freq
    return 0


def bag_of_words(counts: DataFrame, vocab: DataFrame, key: str = "doc_id") -> DataFrame:
    """(document, term_id, cnt); tokens outside the vocabulary are dropped.  Both should be stored tables.

    The terms of most documents are sent to every task, and their rows do not move.  Of a vocabulary too large for that, rows
    of rarer terms are shuffled; a term that is common all the same is spread over as many salts as its document frequency
    asks for.
    """
    ids = vocab.select(F.col("term").alias("token"), "term_id", "doc_freq")
    floor = _common_floor(vocab)
    common = F.broadcast(ids.filter(F.col("doc_freq") > floor).drop("doc_freq"))
    found = counts.join(common, "token").select(key, "term_id", "cnt")
    if floor == 0:
        return found
    rest = vocab.filter(F.col("doc_freq") <= floor)
    hold = F.greatest(F.lit(TASK_ROWS), rest.agg(F.sum("doc_freq")).scalar() / MOST_HEAVY)
    heavy = rest.filter(F.col("doc_freq") > hold).select(
        F.col("term").alias("token"), F.ceil(F.col("doc_freq") / hold).alias("_salts"))
    others = salted_lookup(counts.join(common, "token", "left_anti"), ids.filter(F.col("doc_freq") <= floor).drop("doc_freq"), "token", heavy, [key])
    return found.unionByName(others.select(key, "term_id", "cnt"))


def bow_arrays(bow: DataFrame, key: str = "doc_id") -> DataFrame:
    """One sorted array of (term_id, cnt) per document."""
    return bow.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("term_id", "cnt"))).alias("bow")
    )
