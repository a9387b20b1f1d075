"""Words as numbers inside a task: hashes of words, tables of words that every task holds, counts of words and of pairs.

A batch's words are coded by Arrow, so strings are looked at once for each different word of a batch; everything else
is arithmetic on whole numbers.  Hashes only find a word: equality is always decided on the word itself, or on a vocabulary
of which it was checked that no two words share a hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paperloom.memory import released
from paperloom.operators.skew import fits_broadcast
from paperloom.session import staged

# Rows of a batch of counts.
COUNT_ROWS = 1 << 16
# What a table of words that every task holds may have at most: a task takes some 60 bytes a row.
TABLE_ROWS, TABLE_BYTES = 4_000_000, 320 << 20


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False).view(np.int64)


def word_hash(column: str = "token"):
    """`hashes` as a column."""
    @F.arrow_udf("bigint")
    def of(words: pa.Array) -> pa.Array:
        return pa.array(hashes(words))

    return of(F.col(column))


class WordTable:
    """Different words, numbered; `places` finds the words of a batch among them."""

    def __init__(self, words: pa.Array):
        found = hashes(words)
        order = np.argsort(found, kind="stable")
        self.hashes, self.words = found[order], words.take(pa.array(order))
        self.distinct = not (self.hashes[1:] == self.hashes[:-1]).any()

    def places(self, words: pa.Array) -> np.ndarray:
        """The number of each word, or -1."""
        if not len(self.words) or not len(words):
            return np.full(len(words), -1, np.int64)
        if not self.distinct:
            return pc.index_in(words, self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        asked = hashes(words)
        at = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
        maybe = np.flatnonzero(self.hashes[at] == asked)
        same = pc.equal(self.words.take(pa.array(at[maybe])), words.take(pa.array(maybe))).to_numpy(zero_copy_only=False)
        place = np.full(len(words), -1, np.int64)
        place[maybe[same]] = at[maybe[same]]
        return place


def coded(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of token arrays, the number of each token's word (of a null: how many words there are), lengths of the arrays."""
    codes = lists.flatten().dictionary_encode()
    place = codes.indices.fill_null(len(codes.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
    return codes.dictionary, place, pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def no_pair(lengths: np.ndarray) -> np.ndarray:
    """Positions, in the arrays laid end to end, of words that no word of their own array follows."""
    return np.cumsum(lengths)[lengths > 0] - 1


def slices(names: list[str], *columns: pa.Array):
    """Record batches of bounded size."""
    for k in range(0, len(columns[0]), COUNT_ROWS):
        yield pa.RecordBatch.from_arrays([c.slice(k, COUNT_ROWS) for c in columns], names)


def _words(batches):
    for batch in batches:
        names, place, _ = coded(batch.column(0))
        counts = np.bincount(place, minlength=len(names))[:len(names)]
        yield from slices(["token", "cnt"], names, pa.array(counts.astype(np.int64)))


def _pairs(batches):
    for batch in batches:
        names, place, lengths = coded(batch.column(0))
        heads = np.ones(len(place), bool)
        heads[no_pair(lengths)] = False
        at = np.flatnonzero(heads)
        found, counts = np.unique(place[at] * (len(names) + 1) + place[at + 1], return_counts=True)
        left, right = np.divmod(found, len(names) + 1)
        known = np.append(hashes(names), 0)
        yield from slices(["left", "right", "cnt"], *(pa.array(known[c], mask=c == len(names)) for c in (left, right)), pa.array(counts.astype(np.int64)))


def word_counts(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """(token, cnt): occurrences of every token in the corpus, counted batch by batch before they are shuffled."""
    parts = tokens.select(column).mapInArrow(released(_words), "token string, cnt bigint")
    return parts.groupBy("token").agg(F.sum("cnt").alias("cnt"))


def pair_hash_counts(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """(left, right, cnt): adjacent pairs by the hashes of their words; a null word has a null hash."""
    parts = tokens.select(column).mapInArrow(released(_pairs), "left bigint, right bigint, cnt bigint")
    return parts.groupBy("left", "right").agg(F.sum("cnt").alias("cnt"))


def rows_by_key(tokens: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key no other row has, and all other rows; without any of these None."""
    repeated = staged(tokens.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n")).filter("n > 1").select("_key"), "repeated-keys")
    if repeated.isEmpty():
        return tokens, None
    if not fits_broadcast(repeated):
        return tokens.limit(0), tokens
    again, same = F.broadcast(repeated), F.col(key).eqNullSafe(F.col("_key"))
    return tokens.join(again, same, "left_anti"), tokens.join(again, same, "left_semi")
