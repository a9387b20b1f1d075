"""Means of word vectors: a table of words and vectors that every task holds, or reads block by block, and sums made where
documents are read."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from paperloom.memory import released
from paperloom.operators.word_codes import TABLE_BYTES, TABLE_ROWS, WordTable, coded, word_hash
from paperloom.session import run_tasks, scratch_path, staged
from paperloom.sources.storage import get_file, put_file

# Bytes of a block of a table too large for every task, and tokens that a task holds while the blocks pass.
BLOCK_BYTES, HELD_TOKENS = 48 << 20, 4 << 20
# Vectors that are looked up at once, and rows with vectors that a task should hold, by what they take in memory.
SLICE_BYTES, TASK_BYTES = 8 << 20, 128 << 20


class VectorTable:
    """Different words, their vectors and their weights."""

    def __init__(self, words: pa.Array, vectors: np.ndarray, weights: np.ndarray):
        self.table = WordTable(words)
        order = np.argsort(self.table.places(words))
        self.vectors, self.weights = vectors[order], weights[order]

    @property
    def width(self) -> int:
        return self.vectors.shape[1]

    def sums(self, names: pa.Array, place: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each token array (coded) the sum of its words' vectors by their weights, and these weights (0: none is known)."""
        known = np.append(self.table.places(names), -1)[place]
        at = np.flatnonzero(known >= 0)
        row = np.repeat(np.arange(len(lengths)), lengths)[at]
        found, cnt = np.unique(row * len(self.vectors) + known[at], return_counts=True)
        row, word = np.divmod(found, len(self.vectors))
        share = cnt * self.weights[word]
        total = np.bincount(row, share, len(lengths)).astype(np.float64)  # whole numbers if there are no words
        sums = np.zeros((len(lengths), self.vectors.shape[1]))
        step = max(1, SLICE_BYTES // (8 * sums.shape[1]))
        for k in range(0, len(row), step):
            part = slice(k, k + step)
            here, begins = np.unique(row[part], return_index=True)
            with np.errstate(invalid="ignore"):  # infinite components
                sums[here] += np.add.reduceat(self.vectors[word[part]] * share[part, None], begins)
        return sums, total


class SpreadTable:
    """A table of words and vectors stored in blocks by hashes of the words, each of them a `VectorTable`."""

    def __init__(self, root: str, blocks: int, width: int):
        self.root, self.blocks, self.width = root, blocks, width

    def tables(self):
        for b in range(self.blocks):
            if (data := get_file(f"{self.root}/{b}")) is not None:
                yield pickle.loads(data)


def _seen(table: DataFrame):
    """What `vector_table` has to know of (word, vector, weight), and the kind of its components."""
    kind = "float" if table.schema["vector"].dataType.elementType.simpleString() == "float" else "double"
    sound = ~F.exists("vector", lambda x: x.isNull()) & (F.col("weight") > 0) & (F.col("weight") < float("inf"))
    seen = table.agg(
        F.count("*").alias("n"), F.sum(F.octet_length("word")).alias("text"),
        F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("width"),
        F.every(F.coalesce(sound, F.lit(False))).alias("sound")).first()
    if not seen.sound or not 0 < seen.least == seen.width:
        return None, 0, kind
    return seen, seen.n * (seen.width * (4 if kind == "float" else 8) + 32) + seen.text, kind


def vector_table(table: DataFrame):
    """`VectorTable` of (word, vector, weight), sent to every task, or a stored `SpreadTable` if it is too large for that.

    None if vectors differ in width, lack components or have no positive weight: then what counts is only known for each
    document.
    """
    seen, size, kind = _seen(table)
    if seen is None:
        return None
    if seen.n > TABLE_ROWS or size > TABLE_BYTES:
        return spread_table(table)
    found = table.select("word", F.col("vector").cast(f"array<{kind}>").alias("vector"), "weight").toArrow()
    words = found["word"].cast(pa.string()).combine_chunks()
    if pc.count_distinct(words).as_py() < len(words):
        return vector_table(_merged(table))
    vectors = found["vector"].combine_chunks().flatten().to_numpy().reshape(-1, seen.width)
    return table.sparkSession.sparkContext.broadcast(VectorTable(words, vectors, found["weight"].to_numpy()))


def spread_table(table: DataFrame) -> SpreadTable | None:
    """`SpreadTable` of (word, vector, weight), of any size; None as in `vector_table`."""
    seen, size, kind = _seen(table)
    if seen is None:
        return None
    if not table.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return spread_table(staged(_merged(table), "merged-words"))
    blocks = max(1, -(-size // BLOCK_BYTES))
    root = scratch_path(table.sparkSession, "word-blocks")

    def run(batches):
        held = {}
        for batch in batches:
            block = batch.column(0).to_numpy(zero_copy_only=False)
            for b in np.unique(block):
                held.setdefault(int(b), []).append(batch.filter(pa.array(block == b)))
        for b in list(held):
            rows = pa.Table.from_batches(held.pop(b)).combine_chunks()
            vectors = rows["vector"].combine_chunks().flatten().to_numpy().reshape(-1, seen.width)
            made = VectorTable(rows["word"].cast(pa.string()).combine_chunks(), vectors, rows["weight"].to_numpy())
            put_file(f"{root}/{b}", pickle.dumps(made, protocol=5))
            yield pa.RecordBatch.from_pydict({"block": [b]})

    block = F.pmod(word_hash("word"), F.lit(blocks)).alias("block")
    dealt = table.select(block, "word", F.col("vector").cast(f"array<{kind}>").alias("vector"), F.col("weight").cast("double").alias("weight"))
    run_tasks(dealt.repartitionById(blocks, F.col("block").cast("int")).mapInArrow(released(run), "block long"))
    return SpreadTable(root, blocks, seen.width)


def _merged(table: DataFrame) -> DataFrame:
    """One row per word: what its rows weigh together, and their mean."""
    vector = array_to_vector(F.col("vector").cast("array<double>"))
    one = table.groupBy("word").agg(Summarizer.mean(vector, F.col("weight")).alias("mean"), F.sum("weight").alias("weight"))
    return one.select("word", vector_to_array("mean").alias("vector"), "weight")


def _all_sums(table, batches, add):
    """(batch, sums, weights) of batches (key, tokens); a stored table is read once for so many tokens as a task holds."""
    def flushed():
        made = [(np.zeros((len(c[2]), table.width)), np.zeros(len(c[2]))) for _, c in held]
        for block in table.tables():
            for (sums, total), (_, c) in zip(made, held):
                more, weights = add(block, *c)
                sums += more
                total += weights
        for (batch, _), (sums, total) in zip(held, made):
            yield batch, sums, total

    held, size = [], 0
    for batch in batches:
        lists = coded(batch.column(1))
        if not isinstance(table, SpreadTable):
            yield batch, *add(table.value, *lists)
            continue
        held.append((batch.select([0]), lists))
        size += len(lists[1]) + len(lists[2])
        if size >= HELD_TOKENS:
            yield from flushed()
            held, size = [], 0
    if held:
        yield from flushed()


def document_means(tokens: DataFrame, table, key: str, column: str) -> DataFrame:
    """(document, vector, n): of each row the mean of its words' vectors, null without a known word, and their weight."""
    def run(batches):
        for batch, sums, total in _all_sums(table, batches, VectorTable.sums):
            known = total > 0
            vectors = sums / np.where(known, total, 1.0)[:, None] + 0.0
            offsets = np.append(0, np.cumsum(known * vectors.shape[1])).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors[known].ravel()), mask=pa.array(~known))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(total)], [key, "vector", "n"])

    kind = tokens.schema[key].dataType.simpleString()
    return tokens.select(key, column).mapInArrow(released(run), f"`{key}` {kind}, vector array<double>, n double")


def document_sums(tokens: DataFrame, table: SpreadTable, add, key: str, column: str = "tokens") -> DataFrame:
    """(document, sums, n) of each row, as `add(a block's VectorTable, different words, their numbers in arrays, lengths)` makes them."""
    def run(batches):
        for batch, sums, total in _all_sums(table, batches, add):
            ends = pa.array(np.arange(len(sums) + 1, dtype=np.int32) * table.width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(sums.ravel())), pa.array(total)], [key, "sums", "n"])

    kind = tokens.schema[key].dataType.simpleString()
    return tokens.select(key, column).mapInArrow(released(run), f"`{key}` {kind}, sums array<double>, n double")


def tasks_for(rows: int, width: int, least: int) -> int:
    """How many tasks hold so many rows with vectors; at least as many as shuffles have."""
    return max(least, -(-rows * (8 * width + 96) // TASK_BYTES))


def weighted_means(rows: DataFrame, key: str, tasks: int) -> DataFrame:
    """(document, vector): mean of the vectors of a document's rows, weighted by `n`.

    Rows are dealt to `tasks` by document before they are aggregated: the aggregate keeps the rows of a task, each with
    its vector, so what a task holds must not depend on how many partitions shuffles have.
    """
    return rows.repartition(tasks, key).groupBy(key).agg(
        Summarizer.mean(array_to_vector("vector"), F.col("n")).alias("vector")
    ).select(key, vector_to_array("vector").alias("vector"))
