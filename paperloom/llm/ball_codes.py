"""Vector code compression: product codes whose codebooks come from ball k-means, in whole numbers.

Components become floor(scale * x); a vector is cut into equal parts, each coded by its nearest codebook entry (squared
Euclidean distance, ties to the lower index).  Codebooks start as the parts of the vectors of the least ids; in each
round every part is assigned, then each entry becomes the floor of its parts' mean; entries without parts stay.

An entry and its parts are a ball.  After the first round a part is compared with few entries, with the same result:

* its distance to the entry it had, moved since, is taken first; a ball's radius is the largest such distance, bounded
  by that to the old entry plus the entry's shift;
* only entries less than two radii away from a ball's entry are its neighbours, ordered by distance;
* a part nearer to its entry than half the way to the first neighbour is in the stable core and keeps it;
* half the ways to the neighbours cut the rest into rings: a part between the m-th and the next one is
  compared with the first m neighbours alone.

Bounds leave room for rounding; distances that decide are exact, in whole numbers below 2**53 or in 64-bit integers, and
a table with components too large for either raises a ValueError.

Each round is one pass that writes vectors with their entries, and one aggregate, combined in the tasks, of which the driver
gets a row for each part position and entry: entries x width numbers, whatever the table's size.  That and the codebooks
are all that is broadcast.  Rows are never dealt by entry, so a large ball is no large task.  A round's table replaces
the one before it, so lost executors cost tasks of one round, and disk holds two.

Vectors that are null, empty or hold null or non-finite components take no part, nor do those of another width than the
first (by id).  Repeated rows and ids are kept, each row coded.  Starting vectors are ordered by id, null ids last, then by
components.  With fewer vectors than entries, there are as many entries as vectors.  An empty table has an empty result and
codebooks without entries.  Other columns are returned as they are, but for those named entries and error, which are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import scratch_path
from paperloom.session import discard

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rows that a task works on at once.
ROWS = 16_384
_ROOM = 1 + 1e-9


class Balls:
    """One part position's entries, with each one's neighbours in order of distance and half the ways to them."""

    def __init__(self, entries: np.ndarray, radius: np.ndarray | None = None):
        self.entries, self.squares = entries, (entries * entries).sum(axis=1)
        if radius is None:
            return
        apart = np.sqrt(self.distances(entries, np.arange(len(entries))).astype(np.float64)) / 2
        np.fill_diagonal(apart, np.inf)
        apart[apart > radius[:, None] * _ROOM + 1e-9] = np.inf
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.half = np.take_along_axis(apart, self.order, axis=1)

    def distances(self, parts: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exact squared distances of parts to some entries."""
        return (parts * parts).sum(axis=1)[:, None] + self.squares[which] - 2 * (parts @ self.entries[which].T)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part, by all entries."""
        found, far = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        for k in range(0, len(parts), 4096):
            apart = self.distances(parts[k: k + 4096], np.arange(len(self.entries)))
            found[k: k + 4096] = apart.argmin(axis=1)
            far[k: k + 4096] = apart.min(axis=1)
        return found, far

    def moved(self, parts: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of each part, from the entry that it had; and the distances taken."""
        step = parts - self.entries[held]
        far = (step * step).sum(axis=1).astype(np.int64)
        reach = np.sqrt(far.astype(np.float64)) * _ROOM + 1e-9
        found, taken = held.copy(), len(parts)
        by = np.argsort(held, kind="stable")
        for ball in np.split(by, np.flatnonzero(np.diff(held[by])) + 1) if len(by) else []:
            own = int(held[ball[0]])
            ring = np.searchsorted(self.half[own], reach[ball], side="right")
            # Rings 1, 2, 3 to 4, 5 to 8 and so on are looked at together; ring 0 is the core.
            level = np.ceil(np.log2(np.maximum(ring, 1))).astype(np.int64)
            for same in np.unique(level[ring > 0]).tolist():
                some = ball[(ring > 0) & (level == same)]
                rings = ring[(ring > 0) & (level == same)]
                which = self.order[own, : int(rings.max())]
                apart = self.distances(parts[some], which).astype(np.int64)
                taken += apart.size
                apart[np.arange(len(which)) >= rings[:, None]] = np.iinfo(np.int64).max >> 9
                ranked = apart * len(self.entries) + which
                best = np.minimum(ranked.min(axis=1), far[some] * len(self.entries) + own)
                far[some], found[some] = best // len(self.entries), best % len(self.entries)
        return found, far, taken


def _usable(vector):
    return F.coalesce(F.size(vector) > 0, F.lit(False)) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _assigned(rows: DataFrame, books: list[Balls], kind) -> DataFrame:
    """`rows` (own, whole, entries) with the entries of now and the squared distances to them."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts = len(books)

    def together(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= ROWS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
        if size:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches):
        for table in together(batches):
            n = table.num_rows
            if not n:
                continue
            own, whole, before = (table.column(i).chunk(0) for i in range(3))
            cells = whole.flatten().to_numpy().reshape(n, parts, -1).astype(kind)
            held = None if before.null_count else before.flatten().to_numpy().reshape(n, parts).astype(np.int64)
            entries, far = np.empty((n, parts), np.int32), np.empty((n, parts), np.int64)
            for p, balls in enumerate(shared.value):
                one = np.ascontiguousarray(cells[:, p])
                entries[:, p], far[:, p] = balls.nearest(one) if held is None else balls.moved(one, held[:, p])[:2]
            ends = pa.array(np.arange(0, n * parts + 1, parts), pa.int32())
            lists = (pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (entries, far))
            yield pa.RecordBatch.from_arrays([own, whole, *lists], ["own", "whole", "entries", "far"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("own", "whole")}
    return rows.mapInArrow(run, f"own {kinds['own']}, whole {kinds['whole']}, entries array<int>, far array<bigint>")


def _next_books(rows: DataFrame, books: list[Balls], kind) -> list[Balls]:
    """Codebooks after a round, from its sums, counts and largest distances."""
    width = books[0].entries.shape[1]
    cut = F.array(*(F.struct(F.lit(p).alias("part"), F.col("entries")[p].alias("entry"), F.col("far")[p].alias("far"),
                             F.slice("whole", p * width + 1, width).alias("cells")) for p in range(len(books))))
    sums = rows.select(F.explode(cut).alias("p")).select("p.*").groupBy("part", "entry").agg(
        F.count("*").alias("n"), F.max("far").alias("far"), F.array(*(F.sum(F.col("cells")[i]) for i in range(width))).alias("total"))
    found = [(b.entries.copy(), np.zeros(len(b.entries))) for b in books]
    for row in sums.collect():
        entries, radius = found[row.part]
        new = np.array([x // row.n for x in row.total], np.int64)
        step = new - entries[row.entry].astype(np.int64)
        radius[row.entry] = np.sqrt(float(row.far)) + np.sqrt(float((step * step).sum()))
        entries[row.entry] = new.astype(kind)
    return [Balls(entries, radius) for entries, radius in found]


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, list[np.ndarray]]:
    """(`vectors` without the vector, with entries and error; the codebooks).

    `entries` are the numbers of a vector's codebook entries by part, `error` their squared distances summed.  The
    codebooks are an array of entries x (width / parts) for each part.  The result is stored in the shared folder.
    """
    spark = vectors.sparkSession
    others = [c for c in vectors.columns if c not in (vector, "entries", "error")]
    cells = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    path = scratch_path(spark, "vector-codes")
    (vectors.where(_usable(vector))
     .select(F.struct(*others, F.lit(0).alias("_")).alias("own"), F.col(key).alias("key"), cells.alias("whole"), F.lit(None).cast("array<int>").alias("entries"))
     .write.parquet(path))
    rows = spark.read.parquet(path)
    first = rows.orderBy(F.col("key").asc_nulls_last(), "whole").select("whole").limit(1).collect()
    width = len(first[0].whole) if first else parts
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    rows = rows.where(F.size("whole") == width)
    largest = rows.agg(F.max(F.greatest(F.array_max("whole"), -F.array_min("whole")))).first()[0] or 1
    if 4 * width * largest * largest * entries >= 1 << 62:
        raise ValueError("components are too large for exact distances")
    kind = np.float64 if 4 * width * largest * largest < 1 << 53 else np.int64
    start = np.array([r.whole for r in rows.orderBy(F.col("key").asc_nulls_last(), "whole").select("whole").limit(entries).collect()])
    start = start.reshape(-1, parts, width // parts).astype(kind)
    books = [Balls(np.ascontiguousarray(start[:, p])) for p in range(parts)]

    rows = rows.select("own", "whole", "entries")
    for left in reversed(range(rounds + 1)):
        last, path = path, scratch_path(spark, "vector-codes")
        _assigned(rows, books, kind).write.parquet(path)
        discard(spark, last)
        rows = spark.read.parquet(path)
        if left:
            books = _next_books(rows, books, kind)
    error = F.aggregate("far", F.lit(0).cast("bigint"), lambda s, x: s + x)
    coded = rows.select(*(F.col("own")[c].alias(c) for c in others), "entries", error.alias("error"))
    return coded, [b.entries.astype(np.int64) for b in books]


def code_text(entries="entries"):
    """Entry numbers as two hexadecimal digits each, by part."""
    return F.array_join(F.transform(entries, lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")


def books_text(books: list[np.ndarray]) -> str:
    """All components by part, entry and position, as decimals parted by commas."""
    return ",".join(str(x) for book in books for x in book.ravel().tolist())
