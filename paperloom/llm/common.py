"""Helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.memory import bounded_batches, give_back, released
from paperloom.session import scratch_path, shared_dir, ship_package, staged

__all__ = ["bounded", "bounded_batches", "components", "give_back", "read_table", "released", "scratch_path", "shared_dir", "staged",
           "words_column"]

# Runs of ASCII letters and digits and of anything outside ASCII.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Rows of a table of a few narrow columns that may be broadcast.
BROADCAST_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text):
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words_column(text):
    """Lower-cased words of a text column; null text has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD_PATTERN})"), F.lit(1))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values, so that all bits depend on all bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (32, 0xD6E8FEB86659FD93)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(32)
    return x


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand.

    With prefix sums S[i] = sum of c[j] * base**j, the value of c[a:b] is
    (S[b] - S[a]) * base**-a whatever its place.
    """

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])

    def sums(self, values: np.ndarray) -> np.ndarray:
        self.grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * self.up[: len(values)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of `edges` (a long, b long): rows (node, component = smallest node reached).

    Alternates large-star and small-star steps; each round's edges are written to the shared folder, so
    lineage stays short and a lost executor costs one round.  Stars become flat in a number of rounds that
    grows with the logarithm of the longest chain; `rounds` only guards against a defect and raises.
    """
    name = "components"
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), name)
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .unionByName(down.select("a", F.col("m").alias("b"))).distinct())
        now = staged(small, name)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def bounded(table: DataFrame) -> DataFrame:
    """`table`, marked for broadcast if it is small enough; meant for stored tables of a few narrow columns."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table
