"""N-gram Jaccard join with adaptive multi-match prefixes: connected components of near-duplicate documents.

A document is the set of its distinct word shingles.  Documents of equal sets are one class from the start; all
that follows is done on classes.

1.  Shingles are in one global order: those that a sketch of all base prefixes shows as frequent come last,
    the others by hash.  A set of n shingles has a base prefix of n - ceil(t n) + 1.  Where the sketch predicts many
    candidates, the prefix is lengthened by l - 1, and a partner then has to share l prefix shingles: a pair
    links only if the prefixes share min(l, l') of them.
2.  Only prefix rows travel.  A shingle with one class is dropped.  A class whose remaining shingles cannot
    reach the number any partner would have to share is dropped; the others keep, rarest first, just enough
    of them for every link to meet at one (s - l + 1 of s).
3.  In a group of classes that share a shingle, each is first compared with one member only, a few times over
    with other members.  Linked classes are one component, so a large group of copies needs a
    number of comparisons in proportion to its size.  What is left, pairs of different components in one
    group, is then compared in full, so no link between different texts is lost; sizes and parity bits of
    the sets are looked at inside the join, before a pair is a row.
4.  Every pair is verified on the whole sets.

Shingles are 64-bit hashes.  Null text or text without words has the empty set and stays alone; with fewer words than a
shingle has, the whole sequence is the one shingle.  Null doc_ids take part but name no component (null if it
has no other).  Repeated rows are members of one class.  Columns besides id and text are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import Powers, bounded, components, mixed, released, staged

WORDS, PERCENT = 5, 80
SKETCH = 1 << 18          # counters of the sketch
STARS = 2                 # rounds of comparing with one member
BITS = 1024               # parity bits of a set
CHANCE = 0.05             # other documents that a shingle of ordinary text meets
_powers = Powers(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace").lower(), np.uint8)
    word = np.ones(len(raw) + 2, bool)
    word[1:-1] = (raw == 0x20) | ((raw >= 9) & (raw <= 0x0D))
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    whole = np.empty(len(starts), np.uint64)
    for first in range(0, len(starts), 1 << 18):  # long texts piece by piece
        s, e = starts[first: first + (1 << 18)], ends[first: first + (1 << 18)]
        base = s[0]
        sums = _powers.sums(raw[base: e[-1]].astype(np.uint64) + np.uint64(1))
        whole[first: first + len(s)] = _powers.between(sums, s - base, e - base)
    whole = mixed(whole + (ends - starts).astype(np.uint64))
    n = min(size, len(whole))
    total = np.zeros(len(whole) - n + 1, np.uint64)
    for k in range(n):
        total += whole[k: len(whole) - n + 1 + k] * np.uint64((0xBF58476D1CE4E5B9 * (2 * k + 3)) % (1 << 64))
    return np.unique(mixed(total + np.uint64(n)))


def class_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def base_prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def usual_share(n: int, percent: int) -> int:
    """Prefix shingles to share where no shingle is frequent; by size, so that the least of a possible partner is known."""
    return 1 if CHANCE * base_prefix(n, percent) <= 1 else 1 + n // 20


def choose_prefix(shingles: np.ndarray, frequency: np.ndarray, usual: float, percent: int) -> tuple[np.ndarray, int]:
    """(prefix shingles, how many of them a partner has to share)."""
    n = len(shingles)
    seen = frequency[(shingles >> np.uint64(46)).astype(np.int64)]
    # What a counter holds beyond the usual and its scatter is the shingle's own.
    own = np.maximum(seen - usual - 4 * math.sqrt(usual) - 8, 0)
    heavy = own > 4 * usual + 64
    ordered = np.concatenate([shingles[~heavy], shingles[heavy]])
    own = np.concatenate([own[~heavy], own[heavy]])
    length = base_prefix(n, percent)
    cost = own[:length].sum()  # documents that it would meet besides those of ordinary text
    share = usual_share(n, percent) if cost <= 1024 else 1 + n // 10 if cost <= 65536 else 1 + n // 5
    return ordered[: length + share - 1], share


def _arrow(columns, names, kinds):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def classes_and_sketch(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Stored rows (doc_id, mark, cid, n) of all documents, and (slot, n) of the sketch."""
    def run(batches):
        sketch, known = np.zeros(SKETCH, np.int64), set()
        names = ["doc_id", "mark", "cid", "n", "slot"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        for batch in batches:
            cids, sizes = [], []
            for text in batch.column(2).to_pylist():
                shingles = shingle_set(text, size)
                cids.append(class_id(shingles))
                sizes.append(len(shingles))
                if len(shingles) and cids[-1] not in known:
                    known.add(cids[-1])
                    slots = shingles[: base_prefix(len(shingles), percent)] >> np.uint64(46)
                    np.add.at(sketch, slots.astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cids, kinds[2]), pa.array(sizes, kinds[3]), pa.nulls(len(cids), kinds[4])], names)
        slots = np.flatnonzero(sketch)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(slots), kinds[0]), pa.nulls(len(slots), kinds[1]), pa.nulls(len(slots), kinds[2]),
             pa.array(sketch[slots], kinds[3]), pa.array(slots, kinds[4])], names)

    return staged(docs.mapInArrow(released(run), "doc_id long, mark long, cid long, n long, slot int"), "classes")


def prefix_rows(docs: DataFrame, frequency: np.ndarray, usual: float, size: int, percent: int) -> DataFrame:
    """(token, cid, asks) of every class, once per task that sees it.

    `asks` holds how many shingles the class wants to share, and below 32 bits how many any partner wants at least.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequency)

    def run(batches):
        known = set()
        for batch in batches:
            tokens, cids, shares = [], [], []
            for text in batch.column(2).to_pylist():
                shingles = shingle_set(text, size)
                cid = class_id(shingles)
                if not len(shingles) or cid in known:
                    continue
                known.add(cid)
                prefix, share = choose_prefix(shingles, shared.value, usual, percent)
                tokens.append(prefix)
                cids.append(np.full(len(prefix), cid))
                shares.append(np.full(len(prefix), share << 32 | usual_share(-(-percent * len(shingles) // 100), percent)))
            if tokens:
                yield _arrow([_signed(np.concatenate(tokens)), np.concatenate(cids), np.concatenate(shares)],
                             ["token", "cid", "asks"], [pa.int64()] * 3)

    return docs.mapInArrow(released(run), "token long, cid long, asks long")


def _keys(batches):
    """Of each class, the rarest shared shingles that every link must meet at."""
    for batch in batches:
        tokens, cids = [], []
        for cid, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = rows.values
            token, df, least, asks = (rows.field(i).to_numpy() for i in range(4))
            token, first = np.unique(token, return_index=True)
            df, least = df[first], least[first]
            ordered = np.sort(np.maximum(least >> 32, asks[0] & 0xFFFFFFFF))
            possible = np.flatnonzero(np.searchsorted(ordered, ordered, side="right") >= ordered)
            if not len(possible):
                continue
            share = int(ordered[possible[0]])
            kept = np.lexsort((token, df))[: len(token) - share + 1]
            tokens.append(token[kept])
            cids.append(np.full(len(kept), cid))
        if tokens:
            yield _arrow([np.concatenate(tokens), np.concatenate(cids)], ["token", "cid"], [pa.int64(), pa.int64()])


def _verify(percent):
    def run(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def class_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Stored (cid, n, bits, shingles) of the classes `wanted` (cid, doc_id, mark of one member)."""
    members = docs.join(wanted, docs["mark"].eqNullSafe(wanted["own"]) & docs["doc_id"].eqNullSafe(wanted["member"])).select("cid", "text")

    def run(batches):
        known = set()  # repeated rows of a member meet in one task
        for batch in batches:
            cids, sets = [], []
            for cid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if cid not in known:
                    known.add(cid)
                    cids.append(cid)
                    sets.append(shingle_set(text, size))
            bits = [np.packbits(np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1 == 1).view(np.int64) for s in sets]
            yield _arrow([cids, [len(s) for s in sets], bits, [s.tobytes() for s in sets]],
                         ["cid", "n", "bits", "shingles"], [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()])

    return staged(members.mapInArrow(released(run), "cid long, n long, bits array<long>, shingles binary"), "sets")


def near_duplicate_components(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs (doc_id, text)."""
    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    first = classes_and_sketch(narrow, size, percent)
    members = first.where("slot is null").select("doc_id", "mark", "cid", "n")
    counters = np.zeros(SKETCH, np.int64)
    for row in first.where("slot is not null").groupBy("slot").agg(F.sum("n").alias("n")).toLocalIterator():
        counters[row["slot"]] = row["n"]
    prefixes = prefix_rows(narrow, counters, counters.mean(), size, percent)

    by_token = Window.partitionBy("token")
    shared = (prefixes.select("token", "cid", "asks", F.count("*").over(by_token).alias("df"), F.min("asks").over(by_token).alias("least"),
                              (F.min("cid").over(by_token) != F.max("cid").over(by_token)).alias("several"))
              .where("several"))
    keys = staged(shared.groupBy("cid").agg(F.collect_list(F.struct("token", "df", "least", "asks")).alias("rows"))
                  .mapInArrow(released(_keys), "token long, cid long"), "keys")
    several = keys.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    wanted = (members.join(keys.join(several, "token", "left_semi").select("cid").distinct(), "cid", "left_semi").groupBy("cid")
              .agg(F.min(F.struct("mark", "doc_id")).alias("one"))
              .select("cid", F.col("one.mark").alias("own"), F.col("one.doc_id").alias("member")))
    sets = class_sets(narrow, bounded(staged(wanted, "wanted")), size)
    traits = sets.select("cid", "n", "bits")
    keyed = staged(keys.join(sets.select("cid", "n"), "cid"), "keyed")

    def fits(a, b):
        return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)

    def differ(x, y):
        """Fewer differing parity bits than the sets may have different shingles."""
        apart = F.aggregate(F.zip_with(x["bits"], y["bits"], lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
        both = x["n"] + y["n"]
        return apart <= both - 2 * F.ceil(both * percent / F.lit(100.0 + percent))

    def verified(pairs):
        """Pairs that link.  Only the sets that a plausible pair names are moved."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        p, q = traits.withColumnRenamed("cid", "a").alias("p"), traits.withColumnRenamed("cid", "b").alias("q")
        plausible = staged(pairs.join(p, "a").join(q, "b").where(
            differ({"bits": F.col("p.bits"), "n": F.col("p.n")}, {"bits": F.col("q.bits"), "n": F.col("q.n")})).select("a", "b"), "plausible")
        named = plausible.select(F.col("a").alias("cid")).unionByName(plausible.select(F.col("b").alias("cid"))).distinct()
        moved = sets.select("cid", "shingles").join(bounded(staged(named, "named")), "cid", "left_semi")
        x, y = moved.select(F.col("cid").alias("a"), F.col("shingles").alias("x")), moved.select(F.col("cid").alias("b"), F.col("shingles").alias("y"))
        return staged(plausible.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(released(_verify(percent)), "a long, b long"), "edges")

    edges, labels = [], None

    def labelled():
        if labels is None:
            return keyed.withColumn("comp", F.col("cid")).withColumn("weight", F.lit(0))
        weights = labels.groupBy("component").agg(F.count("*").alias("weight"))
        known = labels.join(weights, "component").select("node", "component", "weight")
        return keyed.join(known, keyed["cid"] == known["node"], "left").select(
            "token", "cid", "n", F.coalesce("component", "cid").alias("comp"), F.coalesce("weight", F.lit(0)).alias("weight"))

    for turn in range(STARS):
        # First one member for all the groups it is in, then a different one for each, out of the largest component.
        order = F.xxhash64("cid", F.col("token") * min(turn, 1))
        now = labelled()
        heads = now.groupBy("token").agg(
            F.min(F.struct((-F.col("weight")).alias("w"), order.alias("h"), "cid", "n", "comp")).alias("head"),
            F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
        pairs = (now.join(heads, "token").where("comp <> head.comp").where(fits(F.col("n"), F.col("head.n")))
                 .select(F.col("cid").alias("a"), F.col("head.cid").alias("b")))
        edges.append(verified(pairs))
        together = edges[0]
        for more in edges[1:]:
            together = together.unionByName(more)
        labels = components(together)
    now = labelled()
    mixed_groups = now.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("token")
    rest = staged(now.drop("weight").join(mixed_groups, "token").join(bounded(traits.select("cid", "bits")), "cid"), "rest")
    p, q = rest.alias("p"), rest.alias("q")
    last = (p.join(q, F.col("p.token") == F.col("q.token"))
            .where(F.col("p.cid") < F.col("q.cid")).where(F.col("p.comp") != F.col("q.comp")).where(fits(F.col("p.n"), F.col("q.n")))
            .where(differ({"bits": F.col("p.bits"), "n": F.col("p.n")}, {"bits": F.col("q.bits"), "n": F.col("q.n")}))
            .select(F.col("p.cid").alias("a"), F.col("q.cid").alias("b")))
    labels = components(together.unionByName(verified(last)))

    grouped = (members.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("least"))
               .join(labels, F.col("cid") == labels["node"], "left").select("cid", "least", F.coalesce("component", "cid").alias("comp")))
    names = grouped.groupBy("comp").agg(F.min("least").alias("component_id"))
    final = grouped.select("cid", "comp").join(names, "comp").select("cid", "component_id")
    return (members.where("n > 0").join(final, "cid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .unionByName(members.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))))
