"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector is centred on the mean of all vectors, scaled to length one, rotated by one random orthogonal matrix
and kept as the signs of its components, packed into bits, with two correction scalars: its distance from the mean
and the inner product of the unit vector with its own code.  For a query the inner product with the unit vector is
estimated from the bits, with an error bound that holds with high probability; whatever could still belong to
the `k` nearest by the lower bound of its distance is reranked on the original vectors in double precision.

The index covers every row.  Rows are dealt into blocks by a hash of id and row, queries are sent to each block
and streamed against it: a task holds one block and one batch of queries, and emits only each query's `k` best of
the block, so pairs are never rows and no key or copy of a vector decides where a row goes.

Rows with a null id, a null or empty vector, a null or non-finite component, or only zeros take no part.  A query meets
only vectors of its own width.  Rows that share an id are one vector seen several times: the nearest of them counts.
Ties go to the smaller id.  Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 20240521
#: Standard deviations of the estimate within which the bound keeps a candidate.
SIGMAS = 4.0
#: Rows of a block; its vectors, codes and products fit a task many times over.
BLOCK_ROWS = 16_384


def rotation(width: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    made, upper = np.linalg.qr(np.random.default_rng(SEED + width).standard_normal((width, width)))
    return made * np.sign(np.diag(upper))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, distance from the centre, inner product of unit vector and code) of each row."""
    moved = (vectors - centre) @ turn
    length = np.sqrt((moved * moved).sum(axis=1))
    unit = moved / np.where(length > 0, length, 1)[:, None]
    bits = np.packbits(unit >= 0, axis=1)
    agreement = np.abs(unit).sum(axis=1) / math.sqrt(vectors.shape[1])
    return bits, length, np.where(length > 0, agreement, 1.0)


def estimate(bits, length, agreement, queries, centre, turn):
    """(estimated, lowest plausible) squared distances, rows x queries, from codes and scalars alone."""
    width = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=width).astype(np.float32) * 2 - 1
    moved = (queries - centre) @ turn
    reach = np.sqrt((moved * moved).sum(axis=1))
    unit = moved / np.where(reach > 0, reach, 1)[:, None]
    inner = (signs @ unit.T.astype(np.float32)) / (math.sqrt(width) * agreement[:, None])
    spread = np.sqrt(np.maximum(1 - agreement**2, 0)) / (agreement * math.sqrt(max(width - 1, 1)))
    base = length[:, None] ** 2 + reach[None, :] ** 2
    scale = 2 * length[:, None] * reach[None, :]
    low = np.maximum(base - scale * np.minimum(inner + SIGMAS * spread[:, None] + 1e-5, 1), (length[:, None] - reach) ** 2)
    return base - scale * inner, low


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v as doubles) of the rows that take part."""
    return (table.select(F.col(id_column).cast("long").alias("vec_id"),
                         F.col(vector_column).cast("array<double>").alias("v"))
            .where("vec_id is not null and v is not null")
            .where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
            .where(F.exists("v", lambda x: x != 0)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Block:
    """The rows of one block and width: ids, vectors and their codes."""

    def __init__(self, ids, vectors, centre):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.centre = ids[order], vectors[order], centre
        self.turn = rotation(vectors.shape[1])
        self.codes = encode(self.vectors, centre, self.turn)

    def nearest(self, ids, queries, k):
        """(query id, id, distance) of the k nearest of the block for each query."""
        guess, low = estimate(*self.codes, queries, self.centre, self.turn)
        for j, own in enumerate(ids):
            other = self.ids != own
            if not other.any():
                continue
            first = self._first(other, guess[:, j], k)
            limit = self._kth(self.ids[first], self._distance(first, queries[j]), k)
            chosen = np.flatnonzero(other & (low[:, j] <= limit * limit * (1 + 1e-9)))
            chosen = np.union1d(chosen, first)
            distance = self._distance(chosen, queries[j])
            order = np.lexsort((self.ids[chosen], distance))
            best = self.ids[chosen][order]
            _, once = np.unique(best, return_index=True)
            keep = order[np.sort(once)[:k]]
            for place in keep:
                yield int(own), int(self.ids[chosen[place]]), float(distance[place])

    def _first(self, other, guess, k):
        """The rows of least estimate that hold 4k different ids, or all rows of the block if they hold fewer."""
        rows = np.flatnonzero(other)
        count = 4 * k
        while True:
            first = rows[np.argpartition(guess[rows], count - 1)[:count]] if count < len(rows) else rows
            if len(first) == len(rows) or len(np.unique(self.ids[first])) >= 4 * k:
                return first
            count *= 4

    @staticmethod
    def _kth(ids, distance, k):
        """Distance of the k-th nearest id, each taken at its nearest row; infinite if there are fewer."""
        order = np.lexsort((distance, ids))
        nearest = distance[order][np.concatenate([[True], np.diff(ids[order]) != 0])]
        return np.sort(nearest)[k - 1] if len(nearest) >= k else np.inf

    def _distance(self, rows, query):
        gap = self.vectors[rows] - query
        return np.sqrt((gap * gap).sum(axis=1))


def nearest(table: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id",
            vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of `table` for each row of `queries`.

    Both have an id and a vector column.  A row is no neighbour of a query with the same id.
    """
    data, asked = usable(table, id_column, vector_column), usable(queries, id_column, vector_column)
    centres = {row.width: np.array(row.centre) for row in (
        data.select(F.size("v").alias("width"), F.posexplode("v").alias("pos", "x"))
        .groupBy("width", "pos").agg(F.avg("x").alias("m")).groupBy("width")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centre"))).collect()}
    blocks = max(1, -(-data.count() // BLOCK_ROWS))
    rows = data.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    sent = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    stream = (rows.select("block", F.lit(0).alias("asks"), F.size("v").alias("width"), "vec_id", "v")
              .unionByName(sent.select("block", F.lit(1).alias("asks"), F.size("v").alias("width"), "vec_id", "v"))
              .repartition(blocks, "block").sortWithinPartitions("block", "asks", "width"))

    def search(batches):
        at, held, ready = None, {}, {}
        for batch in batches:
            place, asks, widths = (batch.column(i).to_numpy() for i in range(3))
            ids = batch.column(3).to_numpy()
            cut = np.flatnonzero((np.diff(place) != 0) | (np.diff(asks) != 0) | (np.diff(widths) != 0)) + 1
            out = []
            for start, end in zip([0, *cut], [*cut, len(ids)]):
                if start == end:
                    continue
                if place[start] != at:
                    at, held, ready = place[start], {}, {}
                width = int(widths[start])
                part = _matrix(batch.column(4).slice(start, end - start), width)
                if not asks[start]:
                    held.setdefault(width, []).append((ids[start:end], part))
                    continue
                if width not in ready and width in held:
                    mine = held.pop(width)
                    ready[width] = Block(np.concatenate([x for x, _ in mine]), np.concatenate([x for _, x in mine]), centres[width])
                if width in ready:
                    for low in range(start, end, 256):
                        high = min(low + 256, end)
                        out += ready[width].nearest(ids[low:high], part[low - start: high - start], k)
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                    ["query_id", "vec_id", "score"])

    found = stream.mapInArrow(search, "query_id long, vec_id long, score double")
    best = (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("best")))
    return (best.select("query_id", F.posexplode("best").alias("place", "hit"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score"))
