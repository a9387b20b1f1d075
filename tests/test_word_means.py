"""Vectors are summed where documents are read: no shuffle carries a vector, unless the table of words is too large."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.models import embeddings as E, word_means as M
from paperloom.queries import models, queries
from paperloom.session import staged
from tests.test_in_place import exchanges

ROWS = [(1, ["b", "a", "b", None]), (2, ["z"]), (3, []), (4, None), (None, ["a"]), (5, ["c"] * 3 + ["a", "z"])]
WORDS = [("a", [1.0, 2.0]), ("b", [4.0, -0.0]), ("c", [0.5, -1.0])]


def table(spark, rows=ROWS):
    return staged(spark.createDataFrame(rows, "doc_id long, tokens array<string>"), "rows")


def words(spark, rows=WORDS, kind="float"):
    return staged(spark.createDataFrame(rows, f"word string, vector array<{kind}>"), "words")


def want(rows, known, weights=None):
    """Means of all words of a key's rows, one for each row."""
    made = []
    for key, _ in rows:
        cells = [(w, np.array(v)) for k, tokens in rows if k == key and key is not None for token in tokens or []
                 for word, v in known if token is not None and word == token and v is not None
                 for w in ([1.0] if weights is None else [x for name, x in weights if name == token])]
        made.append((key, [round(x + 0.0, 9) for x in sum(w * v for w, v in cells) / sum(w for w, _ in cells)] if cells else None))
    return sorted(made, key=str)


def got(frame):
    return sorted(((r.doc_id, r.vector and [round(x, 9) for x in r.vector]) for r in frame.collect()), key=str)


def test_vectors_do_not_move(spark):
    frame = E.document_vectors(table(spark), words(spark))
    assert not exchanges(frame)
    assert got(frame) == want(ROWS, WORDS)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_rows_and_words_that_come_twice(spark, monkeypatch, small, kind):
    if not small:
        monkeypatch.setattr(M, "TABLE_BYTES", 0)
    rows = [*ROWS, (1, ["c", "z"]), (2, ["a"]), (3, ["z"]), (None, ["b"]), (5, None)]
    known = [*WORDS, ("a", [3.0, 3.0]), ("b", [4.0, -0.0]), (None, [9.0, 9.0]), ("z", None)]
    assert got(E.document_vectors(table(spark, rows), words(spark, known, kind))) == want(rows, known)
    weights = [("a", 0.5), ("a", 2.0), ("b", 1.5), ("z", 1.0)]
    named = spark.createDataFrame(weights, "word string, weight double")
    assert got(E.document_vectors(table(spark, rows), words(spark, known, kind), weights=named)) == want(rows, known, weights)


@pytest.mark.parametrize("small", [True, False])
def test_slices_and_heavy_words(spark, monkeypatch, small):
    """Lookups of a few vectors at a time, or tasks of a few rows and words dealt over many salts."""
    monkeypatch.setattr(M, "SLICE_BYTES", 48)
    if not small:
        monkeypatch.setattr(M, "TABLE_BYTES", 0)
        for place in (E, M):
            monkeypatch.setattr(place, "TASK_BYTES", 1200)
    rows = [(i, ["hot"] * (1 + i % 3) + [f"w{i * k % 17}" for k in range(i % 7)]) for i in range(300)]
    known = [("hot", [1.0, -2.0])] + [(f"w{k}", [k * 0.25, float(k)]) for k in range(15)]
    assert got(E.document_vectors(table(spark, rows), words(spark, known))) == want(rows, known)


def test_vectors_of_no_common_width(spark):
    rows = [(1, ["a", "a"]), (2, ["b"]), (3, ["z"])]
    assert got(E.document_vectors(table(spark, rows), words(spark, [("a", [1.0]), ("b", [1.0, 2.0])]))) == [(1, [1.0]), (2, [1.0, 2.0]), (3, None)]
    assert got(E.document_vectors(table(spark, rows), words(spark, []))) == [(1, None), (2, None), (3, None)]


def test_rows_of_a_task_are_bounded(spark):
    rows = spark.range(1000).select((F.col("id") % 100).alias("doc_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("vector"), F.lit(2.0).alias("n"))
    made = M.weighted_means(rows, "doc_id", M.tasks_for(3_000_000, 64, 8))
    assert M.tasks_for(10, 64, 8) == 8 and M.tasks_for(6_000_000, 64, 8) == 28
    assert made.rdd.getNumPartitions() == 14 and made.count() == 100


def test_lines_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    """Orders twice, without lines or without keys; lines without orders, keys or parts; more tasks than cores."""
    spark.createDataFrame([(k % 40,) for k in range(60)] + [(None,)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(k % 50, k % 7) for k in range(20, 400) if k % 50 != 3] + [(None, 1), (5, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, [float(k), -1.0]) for k in range(5)] + [(6, None)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    run = queries()["mean_vectors"]
    plain = sorted(map(str, run(spark, str(tmp_path)).collect()))
    monkeypatch.setattr("paperloom.queries.vectors.LINES", 20)
    dealt = run(spark, str(tmp_path))
    assert len(plain) == 61 and sorted(map(str, dealt.collect())) == plain
    assert not any("vector" in moved for moved in exchanges(dealt.filter("doc_id >= 0")) if "n#" not in moved)


def test_a_table_too_large_for_a_task_is_read_in_blocks(spark, monkeypatch):
    """No exchange has a vector, and tasks that hold few tokens read the blocks again."""
    for name, value in (("TABLE_BYTES", 0), ("BLOCK_BYTES", 64), ("HELD_TOKENS", 3)):
        monkeypatch.setattr(M, name, value)
    held = M.vector_table(words(spark).withColumn("weight", F.lit(1.0)))
    assert isinstance(held, M.SpreadTable) and held.blocks > 1 and sorted(w for t in held.tables() for w in t.table.words.to_pylist()) == ["a", "b", "c"]
    frame = E.document_vectors(table(spark), words(spark))
    assert not exchanges(frame) and got(frame) == want(ROWS, WORDS)
    sums = {r.doc_id: (r.sums, r.n) for r in M.document_sums(table(spark), held, models._cell_by_cell, "doc_id").collect()}
    assert sums[1] == ([9.0, 2.0], 3.0) and sums[3] == sums[4] == ([0.0, 0.0], 0.0) and sums[5] == ([2.5, -1.0], 4.0)
