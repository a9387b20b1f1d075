"""Periodic runs of words: descending-LCP Kruskal over suffix classes.

A run is a stretch of words whose smallest period q fits at least twice, that no neighbouring word extends.  Each run
starts at a position i such that the suffixes at i and i + q share exactly the rest of the run, so

* suffixes that share a block of half the least run are found, ordered by prefix doubling over ranks of blocks, and the
  common prefix (LCP) of each two neighbours in that order is read off the ranks of all doublings;
* neighbours are united in order of falling LCP.  A union-find root holds its class's positions in order; the smaller
  class goes into the larger one, and two positions that become neighbours there at a distance of at most the LCP seed a
  run: the distance is its period, and distance plus LCP its length.  Whatever has a smaller period has a position of
  the class in between, so it seeds nothing;
* a seed whose stretch could begin one word earlier lies inside a run that has a seed of its own, and goes.

Every run is found, and found once.  Texts without a repeated block never reach the second step.

A document is one row and is handled in the task that reads it: nothing is shuffled, a task that runs again gives the
same rows, and repeated rows, null or repeated ids do no harm.  Documents are taken together up to `GROUP` words, a longer
one alone, whole; memory is some 10 numbers of 4 bytes a word of such a group, and one a word for each doubling of the
longest repeat.  Null and empty texts, and those of white space only, have no words and no runs.  Columns besides the text
are returned as they are, but for those named n_words, runs and collapsed, which are replaced.  An empty table gives an
empty one.  Runs of the same start differ in period, so their order has no ties.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12
GROUP = 400_000
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Words:
    """Words of several documents as numbers from 1, with a block of zeros behind each document."""

    def __init__(self, texts: list[list[bytes]], block: int):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = list(chain.from_iterable(texts))
        numbers = dict(zip(dict.fromkeys(flat), count(1)))
        self.first = np.cumsum(sizes + block) - sizes - block
        place = np.arange(len(flat)) + np.repeat(self.first - np.cumsum(sizes) + sizes, sizes)
        total = int(sizes.sum()) + block * (len(texts) + 1)
        self.word = np.zeros(total, np.int64)
        self.word[place] = np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat))
        self.owner = np.repeat(np.arange(len(texts) + 1), np.append(sizes + block, block))
        whole = np.minimum(np.maximum(sizes - block + 1, 0), sizes)
        self.starts = np.arange(int(whole.sum())) + np.repeat(self.first - np.cumsum(whole) + whole, whole)


def repeated_blocks(words: Words, block: int) -> np.ndarray:
    """Starts of blocks whose hash another block of the same document has; a few may be there by chance."""
    value = words.owner.astype(np.uint64)[words.starts]
    for k in range(block):
        value = (value + words.word[words.starts + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    order = np.argsort(value)
    same = value[order][1:] == value[order][:-1]
    hit = np.zeros(len(value), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    return words.starts[hit]


def _groups(sorted_keys) -> np.ndarray:
    """For each element of sorted keys, the index of the first one equal to it."""
    new = np.zeros(len(sorted_keys[0]), bool)
    new[:1] = True
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def suffix_order(words: Words, starts: np.ndarray, block: int):
    """(order, lcp): `starts` by document and suffix, and how many words each shares with the next, 0 below a block."""
    ranked = np.unique(np.concatenate([starts, starts + block]))
    keys = [words.word[ranked + k] for k in reversed(range(block))] + [words.owner[ranked]]
    by = np.lexsort(keys)
    rank = np.full(len(words.word), -1, np.int32)
    rank[ranked[by]] = _groups([k[by] for k in keys])
    levels, size, left = [], block, starts
    while True:
        levels.append((size, rank))
        _, group, members = np.unique(rank[left], return_inverse=True, return_counts=True)
        left = left[members[group] > 1]
        if not len(left):
            break
        old, after = rank[left], rank[left + size]
        by = np.lexsort((after, old))
        old, after = old[by], after[by]
        rank = rank.copy()
        rank[left[by]] = old + (_groups([old, after]) - _groups([old]))
        size *= 2
    order = starts[np.argsort(rank[starts], kind="stable")]
    one, two = order[:-1], order[1:]
    lcp = np.zeros(len(one), np.int64)
    for size, rank in reversed(levels):
        lcp += size * (rank[one + lcp] == rank[two + lcp])
    open_ = lcp > 0
    for _ in range(block - 1):
        here = words.word[one + lcp]
        open_ = open_ & (here != 0) & (here == words.word[two + lcp])
        lcp += open_
    return order, lcp


def kruskal(order: np.ndarray, lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """Seeds (position, next position, lcp): unites neighbours of `order` by falling LCP."""
    joins = np.flatnonzero(lcp > 0)
    joins = joins[np.argsort(-lcp[joins], kind="stable")]
    parent = list(range(len(order)))
    held = [[p] for p in order.tolist()]
    seeds = []

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for k, shared in zip(joins.tolist(), lcp[joins].tolist()):
        into, gone = root(k), root(k + 1)
        if len(held[into]) < len(held[gone]):
            into, gone = gone, into
        parent[gone] = into
        large, small, held[gone] = held[into], held[gone], None
        if len(small) * 16 < len(large):
            for p in small:
                insort(large, p)
        else:
            large.extend(small)
            large.sort()
        own = set(small)
        for p in small:
            i = bisect_left(large, p)
            if i and p - large[i - 1] <= shared and large[i - 1] not in own:
                seeds.append((large[i - 1], p, shared))
            if i + 1 < len(large) and large[i + 1] - p <= shared and large[i + 1] not in own:
                seeds.append((p, large[i + 1], shared))
    return seeds


def runs_of(texts: list[list[bytes]], least: int = LEAST):
    """(document, start, length, period) arrays of the runs of at least `least` words, in that order."""
    block = max(1, (least + 1) // 2)
    words = Words(texts, block)
    starts = repeated_blocks(words, block)
    none = np.empty(0, np.int64)
    if not len(starts):
        return none, none, none, none
    seeds = kruskal(*suffix_order(words, starts, block))
    one, two, shared = np.array(seeds, np.int64).reshape(-1, 3).T
    owner = words.owner[one]
    start, period = one - words.first[owner], two - one
    length = period + shared
    first = (start == 0) | (words.word[one - 1] != words.word[two - 1])
    kept = np.flatnonzero(first & (length >= least))
    kept = kept[np.lexsort((period[kept], start[kept], owner[kept]))]
    return owner[kept], start[kept], length[kept], period[kept]


def collapsed(words: list[bytes], start, length, period) -> bytes:
    """The words that no run contains after its first period, joined by blanks."""
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    return b" ".join(compress(words, (np.cumsum(cover[:-1]) == 0).tolist()))


def find_runs(docs: DataFrame, least: int = LEAST, prepare=None, key: str = "doc_id") -> DataFrame:
    """`docs` (text and any other columns) without text, with n_words, runs (start, length, period) and collapsed.

    Words are what ASCII white space parts.  `runs` are those of at least `least` words, by start and period;
    `collapsed` is the text of the words that no run contains after its first period, joined by blanks.
    `prepare(key, words)`, where given, maps the words of a row before anything else; it is sent to the workers.
    """
    docs = docs.drop("n_words", "runs", "collapsed")
    others = [c for c in docs.columns if c != "text"]
    named = F.col(key) if key in others else F.lit(None)
    packed = docs.select(F.struct(*others, F.lit(0).alias("_")).alias("own"), named.alias("key"), F.col("text").cast("string").cast("binary").alias("text"))

    def rows(own, keys, texts):
        words = [(t or b"").split() for t in texts]
        if prepare:
            words = [prepare(k, w) for k, w in zip(keys, words)]
        at = 0
        while at < len(words):
            end, size = at, 0
            while end < len(words) and (end == at or size + len(words[end]) <= GROUP):
                size += len(words[end])
                end += 1
            group = words[at:end]
            owner, start, length, period = runs_of(group, least)
            border = np.searchsorted(owner, np.arange(len(group) + 1))
            runs, texts_left = [], []
            for k, w in enumerate(group):
                s, n, p = (x[border[k]: border[k + 1]] for x in (start, length, period))
                runs.append([{"start": a, "length": b, "period": c} for a, b, c in zip(s.tolist(), n.tolist(), p.tolist())])
                texts_left.append(collapsed(w, s, n, p) if len(s) else b" ".join(w))
            yield pa.RecordBatch.from_arrays(
                [own.slice(at, end - at), pa.array([len(w) for w in group], pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(texts_left, pa.binary())],
                ["own", "n_words", "runs", "collapsed"])
            at = end

    def run(batches):
        for batch in batches:
            yield from rows(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist())

    own = packed.schema["own"].dataType.simpleString()
    found = packed.mapInArrow(run, f"own {own}, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")
    return found.select(*(F.col("own")[c].alias(c) for c in others), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
