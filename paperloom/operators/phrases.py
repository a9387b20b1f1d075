"""Phrase detection: score adjacent pairs, merge the accepted ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, functions as F

from paperloom.memory import released
from paperloom.operators.skew import fits_broadcast, lookup
from paperloom.operators.word_codes import (
    TABLE_BYTES, TABLE_ROWS, WordTable, coded, no_pair, pair_hash_counts, rows_by_key, slices, word_counts, word_hash)
from paperloom.session import staged, staged_by

MIN_COUNT = 5
THRESHOLD = 10.0
DELIMITER = "_"


def pairs_of(tokens) -> Column:
    """Adjacent pairs of a token array as structs (left, right)."""
    words = F.col(tokens) if isinstance(tokens, str) else tokens
    following = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    # zip to the shorter side: the last word starts no pair
    heads = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(
        heads, following, lambda a, b: F.struct(a.alias("left"), b.alias("right"))
    )


def pair_counts(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """(left, right, cnt) of adjacent pairs."""
    each = tokens.select(F.explode_outer(pairs_of(column)).alias("pair")).filter(F.col("pair").isNotNull()).select("pair.*")
    return each.groupBy("left", "right").agg(F.count("*").alias("cnt"))


def phrase_scores(tokens: DataFrame, column: str = "tokens", min_count: int = MIN_COUNT,
                  threshold: float = THRESHOLD, vocabulary_counts_pairs: bool = True) -> DataFrame:
    """Accepted pairs (left, right, cnt, score), as a stored table.

    score = (pair count - min_count) * vocabulary size / (left count * right count)

    The vocabulary size counts words and, by default, pairs as well.  Pairs that
    cannot pass a threshold of zero or more are dropped before the two lookups.
    Pairs are counted by the hashes of their words, if no two words of the corpus
    share one; only the pairs left get their words back.
    """
    words = staged(word_counts(tokens, column).withColumn("hash", word_hash()), "words")
    size = words.agg(F.count("*")).scalar()
    shared = not words.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    pairs = pair_counts(tokens, column) if shared else pair_hash_counts(tokens, column)
    seen = Observation()
    counted = pairs.observe(seen, F.count("*").alias("n"))
    candidates = staged(counted.filter(F.col("cnt") > min_count) if threshold >= 0 else counted, "pairs")
    if vocabulary_counts_pairs:
        size = size + F.lit(seen.get["n"])
    by = "token" if shared else "hash"
    scored = candidates
    for side, other in (("left", "right"), ("right", "left")):
        ids = words.select(F.col(by).alias(side), F.col("token").alias(f"{side}_word"), F.col("cnt").alias(f"{side}_cnt"))
        scored = lookup(scored, ids, side, [other])
    score = (
        (F.col("cnt") - min_count).cast("double")
        / F.col("left_cnt") / F.col("right_cnt") * size
    )
    return staged(
        scored.select(F.col("left_word").alias("left"), F.col("right_word").alias("right"), "cnt", score.alias("score"))
        .filter(F.col("score") > threshold),
        "phrases",
    )


class PhraseTable:
    """The accepted pairs as one array of whole numbers over a table of their words, as every task holds it."""

    def __init__(self, left: pa.Array, right: pa.Array):
        whole = left.is_valid().to_numpy(zero_copy_only=False) & right.is_valid().to_numpy(zero_copy_only=False)
        left, right = left.filter(pa.array(whole)), right.filter(pa.array(whole))
        self.table = WordTable(pa.concat_arrays([left, right]).unique())
        self.pairs = np.unique(self.table.places(left) * len(self.table.words) + self.table.places(right))

    def merges(self, names: pa.Array, place: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Where pairs are merged, in the arrays laid end to end: of pairs that overlap in a chain, every other one."""
        if not len(self.pairs) or len(place) < 2:
            return np.zeros(0, np.int64)
        known = np.append(self.table.places(names), -1)[place]
        maybe = (known >= 0) & (np.append(known[1:], -1) >= 0)
        maybe[no_pair(lengths)] = False
        at = np.flatnonzero(maybe)
        pair = known[at] * len(self.table.words) + known[at + 1]
        at = at[self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair]
        number = np.arange(len(at))
        begins = np.append(True, np.diff(at) != 1)[:len(at)]
        return at[(number - np.maximum.accumulate(np.where(begins, number, 0))) % 2 == 0]


def _phrase_table(phrases: DataFrame):
    """`PhraseTable`, sent to every task, or None if it is too large for that."""
    if not fits_broadcast(phrases.select("left", "right"), TABLE_ROWS, TABLE_BYTES):
        return None
    found = phrases.select("left", "right").toArrow()
    sides = [found[c].cast(pa.string()).combine_chunks() for c in ("left", "right")]
    return phrases.sparkSession.sparkContext.broadcast(PhraseTable(*sides))


def _merging(table, delimiter: str):
    """A function of token arrays that joins accepted pairs, greedily from the left."""
    @F.arrow_udf("array<string>")
    def merged(lists: pa.Array) -> pa.Array:
        names, place, lengths = coded(lists)
        starts = table.value.merges(names, place, lengths)
        if not len(starts):
            return lists
        pairs, which = np.unique(place[starts] * len(names) + place[starts + 1], return_inverse=True)
        left, right = (names.take(pa.array(side)) for side in np.divmod(pairs, len(names)))
        joined = pc.binary_join_element_wise(left, right, delimiter)
        of = np.repeat(np.arange(len(lengths)), lengths)
        changed = np.zeros(len(lengths), bool)
        changed[of[starts]] = True
        keep = (place < len(names)) | ~changed[of]  # a document that is rewritten loses its null words
        keep[starts + 1] = False
        place = np.where(place == len(names), len(names) + len(joined), place)
        place[starts] = len(names) + which
        words = pa.concat_arrays([names, joined, pa.nulls(1, names.type)]).take(pa.array(place[keep]))
        offsets = np.append(0, np.cumsum(np.bincount(of[keep], minlength=len(lengths)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), words, mask=lists.is_null())

    return merged.asNondeterministic()  # else a filter on the result would have it made twice


def _counting(table):
    """A function of Arrow batches (tokens) -> (left, right, cnt) of the merges of each batch."""
    def run(batches):
        for batch in batches:
            names, place, lengths = coded(batch.column(0))
            starts = table.value.merges(names, place, lengths)
            pairs, counts = np.unique(place[starts] * (len(names) + 1) + place[starts + 1], return_counts=True)
            left, right = (names.take(pa.array(side)) for side in np.divmod(pairs, len(names) + 1))
            yield from slices(["left", "right", "cnt"], left, right, pa.array(counts.astype(np.int64)))

    return released(run)


def accepted_positions(tokens: DataFrame, phrases: DataFrame, key: str = "doc_id",
                       column: str = "tokens") -> DataFrame:
    """(doc_id, positions): sorted 0-based positions where an accepted pair begins.

    The phrase table may be of any size; only hits are grouped by document.
    """
    each = tokens.select(key, F.posexplode_outer(pairs_of(column)).alias("pos", "pair")).filter(
        F.col("pair").isNotNull()).select(key, "pos", "pair.left", "pair.right")
    hits = lookup(each, phrases.select("left", "right"), ["left", "right"], [key, "pos"])
    return hits.groupBy(key).agg(F.array_sort(F.collect_list("pos")).alias("positions"))


def merge_starts(positions: Column) -> Column:
    """Which accepted pairs are merged, going through the text from the left.

    A merged pair uses up both its words, so of pairs that overlap in a chain
    every other one is merged.  Written as text, a pair that overlaps the one
    before it is `c` and any other is `s`; each pair then consumes the `c` after
    it, which is what a replacement that does not overlap itself does.
    """
    links = F.transform(
        positions,
        lambda p, i: F.when(F.get(positions, i - 1) == p - 1, "c").otherwise("s"),
    )
    marks = F.split(F.regexp_replace(F.array_join(links, ""), "[sc]c", "Mx"), "")
    merged = F.zip_with(positions, marks, lambda p, m: F.when(m != "x", p))
    return F.filter(merged, lambda p: p.isNotNull())


def token_marks(size: Column, starts: Column) -> Column:
    """One mark per word: `M` begins a phrase, `x` was absorbed, `0` stands alone."""
    upto = F.transform(
        starts,
        lambda at, i: F.concat(
            F.repeat(F.lit("0"), at - F.coalesce(F.get(starts, i - 1) + 2, F.lit(0))), F.lit("Mx")
        ),
    )
    rest = F.repeat(F.lit("0"), size - F.coalesce(F.try_element_at(starts, F.lit(-1)) + 2, F.lit(0)))
    return F.split(F.concat(F.array_join(upto, ""), rest), "")


def with_merges(tokens: DataFrame, phrases: DataFrame, key: str = "doc_id",
                column: str = "tokens") -> DataFrame:
    """Documents that have accepted pairs, with the positions merged, as `starts`."""
    found = accepted_positions(tokens, phrases, key, column)
    starts = found.select(key, merge_starts(F.col("positions")).alias("starts"))
    return tokens.join(starts, key, "left")


def apply_phrases(tokens: DataFrame, phrases: DataFrame, key: str = "doc_id", column: str = "tokens",
                  delimiter: str = DELIMITER) -> DataFrame:
    """Rewrite every document: accepted pairs are joined, greedily from the left.

    `phrases` should be a stored table, as its size is looked at.  It is sent to every task, and a row is rewritten
    where it is read; beyond some millions of phrases pairs are joined to it by their words.  Rows of a key that stands
    several times share the positions found in any of them, and rows without a key are left alone.
    """
    return _applied(tokens, phrases, key, column, delimiter)[0]


def _applied(tokens: DataFrame, phrases: DataFrame, key: str, column: str, delimiter: str = DELIMITER) -> tuple[DataFrame, bool]:
    """`apply_phrases`, and whether rows are rewritten where they are read."""
    tokens = tokens.select(key, *(c for c in tokens.columns if c != key))
    table = _phrase_table(phrases)
    if table is None:
        return _apply_joined(tokens, phrases, key, column, delimiter), False
    one, several = rows_by_key(tokens, key)
    merged = F.when(F.col(key).isNotNull(), _merging(table, delimiter)(F.col(column))).otherwise(F.col(column))
    done = one.withColumn(column, merged)
    return done if several is None else done.unionByName(_apply_joined(several, phrases, key, column, delimiter)), True


def _apply_joined(tokens: DataFrame, phrases: DataFrame, key: str, column: str, delimiter: str) -> DataFrame:
    """`apply_phrases` for a phrase table of any size."""
    marked = with_merges(tokens, phrases, key, column).withColumn(
        "_marks", F.when(F.size("starts") > 0, token_marks(F.size(column), F.col("starts")))
    )
    following = F.concat(F.slice(column, F.lit(2), F.size(column)), F.array(F.lit("")))
    joined = F.zip_with(column, following, lambda a, b: F.concat(a, F.lit(delimiter), b))
    both = F.zip_with(column, joined, lambda w, j: F.struct(w.alias("w"), j.alias("j")))
    chosen = F.zip_with(
        both, F.col("_marks"), lambda b, m: F.when(m == "M", b.j).when(m == "0", b.w)
    )
    merged = F.filter(chosen, lambda t: t.isNotNull())
    return marked.withColumn(
        column, F.when(F.col("_marks").isNull(), F.col(column)).otherwise(merged)
    ).drop("_marks", "starts")


def _merges_joined(tokens: DataFrame, phrases: DataFrame, key: str, column: str) -> DataFrame:
    """(left, right, cnt) of each merge, for a phrase table of any size."""
    marked = with_merges(tokens, phrases, key, column).filter(F.size("starts") > 0)
    return marked.select(F.explode(F.transform(
        "starts", lambda at: F.struct(
            F.get(column, at).alias("left"), F.get(column, at + 1).alias("right"))
    )).alias("pair")).select("pair.*", F.lit(1).cast("bigint").alias("cnt"))


def phrase_report(tokens: DataFrame, phrases: DataFrame, key: str = "doc_id",
                  column: str = "tokens", delimiter: str = DELIMITER) -> DataFrame:
    """phrase -> (score, occurrences), counting merges as they happen in the text (as `apply_phrases` makes them)."""
    table = _phrase_table(phrases)
    if table is None:
        each = _merges_joined(tokens, phrases, key, column)
    else:
        one, several = rows_by_key(tokens, key)
        each = one.filter(F.col(key).isNotNull()).select(column).mapInArrow(_counting(table), "left string, right string, cnt bigint")
        if several is not None:
            each = each.unionByName(_merges_joined(several, phrases, key, column))
    counts = each.groupBy("left", "right").agg(F.sum("cnt").alias("occurrences"))
    return counts.join(phrases.select("left", "right", "score"), ["left", "right"]).select(
        F.concat_ws(delimiter, "left", "right").alias("phrase"), "score", "occurrences"
    )


def detect_ngrams(tokens: DataFrame, rounds: int = 2, key: str = "doc_id", column: str = "tokens",
                  min_count: int = MIN_COUNT, threshold: float = THRESHOLD):
    """Repeat detection on the rewritten text; two rounds reach four words.

    Rows are rewritten where they are read.  With a phrase table too large for that, texts are stored by document; if `tokens`
    is such a table (`paperloom.session.staged_by`), no round moves them.
    Returns the rewritten documents and the phrase table of each round.
    """
    tables = []
    for _ in range(rounds):
        phrases = phrase_scores(tokens, column, min_count, threshold)
        tables.append(phrases)
        merged, in_place = _applied(tokens, phrases, key, column)
        tokens = staged(merged, "ngrams") if in_place else staged_by(merged, key, "ngrams")
    return tokens, tables
