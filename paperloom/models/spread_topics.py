"""Topics by expectation maximisation over blocks of documents.

Counts are stored by blocks of documents and stay there.  In each pass a block works out the topics of its counts, and only
sums of its terms travel: they are added up by ranges of terms, and each block is sent the weights of the terms it has.  The
driver gets one number per topic.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paperloom.memory import released
from paperloom.operators.topk import top_k_per_group
from paperloom.session import discard, staged, staged_by

#: Counts of a block of documents at most, and at least if there are several; terms of a range, counts worked on at a time, rows
#: of an array in a table's row.
BLOCK_COUNTS, FEW_COUNTS, RANGE_TERMS, SLICE, PIECE = 1 << 21, 1 << 14, 1 << 18, 1 << 17, 1 << 13

# Arrays on their way: `kind` "own" are a block's documents, "terms" its terms, "total" its topics.
_ROWS = "target long, source long, kind string, first long, ids binary, data binary"


def _rows(target, source, kind, ids, data):
    for k in range(0, len(data), PIECE):
        yield target, source, kind, k, ids[k:k + PIECE].astype(np.int64).tobytes(), np.ascontiguousarray(data[k:k + PIECE], np.float64).tobytes()


def _table(rows):
    names = ["target", "source", "kind", "first", "ids", "data"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [()] * 6
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _together(rows, topics: int):
    """Ids and data of an array's rows, in the order of their sources and places."""
    rows = sorted(rows, key=lambda r: r[:2])
    return np.frombuffer(b"".join(r[2] for r in rows), np.int64), np.frombuffer(b"".join(r[3] for r in rows), np.float64).reshape(-1, topics)


def _numbered(ids):
    """Different ids, ascending, and the place of each id among them; ids are numbers of terms, so a table of these is small."""
    if not len(ids):
        return ids, np.zeros(0, np.int64)
    held = np.zeros(int(ids.max()) + 1, bool)
    held[ids] = True
    names = np.flatnonzero(held)
    place = np.empty(len(held), np.int32)
    place[names] = np.arange(len(names))
    return names, place[ids]


def _pass(topics: int, seed: int, terms: int, totals, concentration: float, size: int, counts_at_once: int):
    """(a block's documents, weights of its documents and terms) -> their next weights; at first topics are drawn."""
    def run(docs, state):
        if not docs.num_rows:
            return _table([])
        docs = docs.combine_chunks()
        if (np.diff(docs["doc"].to_numpy()) < 0).any():
            docs = docs.sort_by("doc").combine_chunks()
        block = docs["block"][0].as_py()
        lists, counts = (docs[c].chunk(0) for c in ("terms", "counts"))
        doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        names, term = _numbered(lists.flatten().to_numpy())
        cnt = counts.flatten().to_numpy().astype(np.float64)
        of_doc, of_term = np.zeros((len(lists), topics)), np.zeros((topics, len(names)))
        random = np.random.default_rng([seed, block])
        if totals is not None:
            held = {"own": [], "terms": []}
            for source, kind, first, ids, data in zip(*(state[c].to_pylist() for c in ("source", "kind", "first", "ids", "data"))):
                held[kind].append((source, first, ids, data))
            own = np.ascontiguousarray((_together(held["own"], topics)[1] + (concentration - 1)).T)
            ids, weights = _together(held["terms"], topics)
            given = np.empty((len(names), topics))
            given[np.searchsorted(names, ids)] = weights
            given = np.ascontiguousarray(((given + (concentration - 1)) / (np.asarray(totals) + (concentration - 1) * terms)).T)
        for k in range(0, len(cnt), counts_at_once):
            part = slice(k, k + counts_at_once)
            d, t, c = doc[part], term[part], cnt[part]
            lo, hi = (d[0], d[-1] + 1) if len(d) else (0, 0)
            if totals is None:
                gamma = [*random.random((len(d), topics)).T]
            else:
                gamma = [given[z][t] * own[z][d] for z in range(topics)]
            share = c / sum(gamma[1:], gamma[0])
            for z in range(topics):
                gamma[z] *= share
                of_doc[lo:hi, z] += np.bincount(d - lo, gamma[z], hi - lo)
                of_term[z] += np.bincount(t, gamma[z], len(names))
        out = list(_rows(block, block, "own", np.arange(len(of_doc)), of_doc))
        out += _rows(-1, block, "total", np.zeros(1), of_doc.sum(axis=0, keepdims=True))
        of_term = np.ascontiguousarray(of_term.T)
        parts = names // size
        for place in np.unique(parts):
            mine = parts == place
            out += _rows(int(place), block, "terms", names[mine], of_term[mine])
        return _table(out)

    return run


def _ranges(batches, topics: int, size: int):
    """For each range of a task: the first of its terms, the sums of all of its terms, and the terms each block has."""
    held = {}
    for batch in batches:
        for target, source, kind, first, ids, data in zip(*(c.to_pylist() for c in batch.columns)):
            ids = np.frombuffer(ids, np.int64)
            total, sources = held.setdefault(target, (np.zeros((size, topics)), {}))
            total[ids - target * size] += np.frombuffer(data, np.float64).reshape(-1, topics)  # a term once in a row
            sources.setdefault(source, []).append((first, ids))
    for target in sorted(held):
        yield target, *held[target]


def _sent_back(topics: int, size: int):
    """Sums of terms of the blocks -> weights of their terms, for the blocks."""
    def run(batches):
        for target, total, sources in _ranges(batches, topics, size):
            for source, pieces in sources.items():
                ids = np.concatenate([i for _, i in sorted(pieces, key=lambda p: p[0])])
                for row in _rows(source, target, "terms", ids, total[ids - target * size]):
                    yield _table([row]).to_batches()[0]

    return released(run)


def _weights(topics: int, size: int):
    def run(batches):
        for target, total, _ in _ranges(batches, topics, size):
            found = np.flatnonzero(total.any(axis=1))
            for k in range(0, len(found), PIECE):
                at = found[k:k + PIECE]
                ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * topics)
                yield pa.RecordBatch.from_arrays([pa.array(at + target * size), pa.ListArray.from_arrays(ends, pa.array(total[at].reshape(-1)))],
                                                 ["term_id", "weights"])

    return released(run)


class SpreadTopics:
    """A model of topics: the stored table (term_id, weights) with one weight per topic."""

    def __init__(self, table: DataFrame):
        self.table = table

    def vocabSize(self) -> int:
        return self.table.count()

    def describeTopics(self, n: int = 10) -> DataFrame:
        """(topic, termIndices, termWeights): the n strongest terms of each topic, their weights as shares of the topic."""
        each = self.table.select("term_id", F.posexplode("weights").alias("topic", "weight"))
        totals = each.groupBy("topic").agg(F.sum("weight").alias("_total"))
        best = top_k_per_group(each, ["topic"], [F.desc("weight"), F.asc("term_id")], n)
        listed = best.join(F.broadcast(totals), "topic").groupBy("topic").agg(F.array_sort(F.collect_list(
            F.struct("rank", F.col("term_id").alias("id"), (F.col("weight") / F.col("_total")).alias("w")))).alias("_each"))
        return listed.select("topic", F.transform("_each", lambda e: e["id"]).alias("termIndices"),
                             F.transform("_each", lambda e: e["w"]).alias("termWeights"))


def train(bag: DataFrame, terms: int, k: int, passes: int, seed: int, key: str = "doc_id", concentration: float = 1.1) -> SpreadTopics:
    """Topics of a bag of words (document, term_id, cnt) over `terms` terms."""
    spark = bag.sparkSession
    listed = staged(bag.groupBy(key).agg(F.collect_list(F.struct("term_id", "cnt")).alias("pairs")).select(
        F.transform("pairs", lambda p: p["term_id"].cast("long")).alias("terms"), F.transform("pairs", lambda p: p["cnt"].cast("int")).alias("counts")), "bags")
    held = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, min(4 * spark.sparkContext.defaultParallelism, held // FEW_COUNTS), -(-held // BLOCK_COUNTS))
    numbered = listed.withColumn("doc", F.monotonically_increasing_id())
    docs = staged_by(numbered.withColumn("block", F.pmod(F.xxhash64("doc"), F.lit(blocks))), "block", "topic-blocks",
                     min(blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ranges = max(1, -(-terms // RANGE_TERMS))
    totals = before = None
    state = spark.range(0).selectExpr("id AS target", "id AS source", "'' AS kind", "id AS first", "X'' AS ids", "X'' AS data")
    for n in range(passes + 1):
        made = staged(docs.groupBy("block").cogroup(state.groupBy("target")).applyInArrow(_pass(k, seed, terms, totals, concentration, RANGE_TERMS, SLICE), _ROWS), "topic-pass")
        if before is not None:
            discard(spark, before)
        before = made.inputFiles()[0].rsplit("/", 1)[0]
        totals = np.sum([np.frombuffer(r.data) for r in made.filter("kind = 'total'").select("source", "data").orderBy("source").collect()], axis=0).tolist()
        sums = made.filter("kind = 'terms'").repartitionById(ranges, F.col("target").cast("int"))
        state = made.filter("kind = 'own'").unionByName(sums.mapInArrow(_sent_back(k, RANGE_TERMS), _ROWS))
    return SpreadTopics(staged(sums.mapInArrow(_weights(k, RANGE_TERMS), "term_id long, weights array<double>"), "topic-terms"))
