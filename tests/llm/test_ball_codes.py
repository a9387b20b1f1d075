import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.llm import ball_codes as bc
from paperloom.llm import queries as Q

TABLE = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """[(code, error)] and codebooks, by all distances in Python's whole numbers."""
    cells = [[int(np.floor(np.float64(np.float32(x)) * 1024)) for x in v] for _, v in rows]
    width = len(cells[0]) // parts
    cut = [[c[p * width:(p + 1) * width] for p in range(parts)] for c in cells]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, cells[i]))[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p])) for p, x in enumerate(c)] for c in cut]

    for _ in range(rounds):
        now = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cut[i][p] for i in range(len(cut)) if now[i][p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    return [("".join(f"{k:02x}" for _, k in a), sum(d for d, _ in a)) for a in assign()], books


def made(rng, n, width=16, spread=0.2, centres=12):
    middle = rng.normal(size=(centres, width))
    return (middle[rng.integers(centres, size=n)] + spread * rng.normal(size=(n, width))).astype(np.float32)


def run_query(spark, folder, rows, extra=False):
    frame = spark.createDataFrame(rows, TABLE)
    if extra:
        for c in ("entries", "error", "own", "whole", "far", "key", "code"):
            frame = frame.withColumn(c, F.lit("x"))
    frame.repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return Q.queries()["op13_ball_codes"](spark, str(folder)).collect()


def check(got, kept):
    want, books = brute([(k, v) for k, v, _ in kept])
    sums = {}
    for (_, error), (_, _, label) in zip(want, kept):
        sums[label] = sums.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(r.vec_id, r.code, r.error, r.label_error) for r in got], key=key) == sorted(
        [(k, c, e, sums[label]) for (k, _, label), (c, e) in zip(kept, want)], key=key)
    assert {r.codebooks_sha256 for r in got} == {sha}


def test_query_against_all_distances(spark, tmp_path):
    rng = np.random.default_rng(3)
    cells = made(rng, 700)
    kept = [(int(k), [float(x) for x in v], None if k % 5 == 0 else int(k % 3)) for k, v in zip(rng.permutation(3000), cells)]
    kept += [(None, kept[0][1], 1), (kept[1][0], kept[2][1], 2), kept[3], kept[3], (9001, [0.0] * 16, None)]
    odd = [(9002, None, 1), (9003, [None] + [1.0] * 15, 1), (9004, [float("nan")] * 16, 1), (9005, [float("inf")] * 16, 2), (9006, [], 1), (9007, [1.0] * 8, 1)]
    check(run_query(spark, tmp_path, kept + odd, extra=True), kept)


def test_fewer_vectors_than_entries_and_ties(spark, tmp_path):
    rng = np.random.default_rng(5)
    kept = [(k, [float(x) for x in rng.integers(-2, 2, size=8) / 8], k % 2) for k in range(60)]
    check(run_query(spark, tmp_path, kept), kept)


def test_empty_table(spark, tmp_path):
    assert run_query(spark, tmp_path, []) == []


def test_uneven_parts_and_huge_components_are_refused(spark):
    for vector in ([1.0] * 6, [1e20] * 8):
        with pytest.raises(ValueError):
            bc.compress(spark.createDataFrame([(1, vector, 0)], TABLE))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.sampled_from([2, 30, 1000, 1 << 25]))
def test_balls_find_what_all_distances_find(seed, k, size):
    rng = np.random.default_rng(seed)
    kind = np.float64 if size < 1 << 20 else np.int64
    parts = rng.integers(-size, size, size=(300, 4)).astype(kind)
    old = bc.Balls(parts[rng.integers(300, size=k)])
    held, far = old.nearest(parts)
    new = old.entries + rng.integers(-max(1, size // 5), max(1, size // 5) + 1, size=(k, 4)).astype(kind)
    radius = np.array([np.sqrt(far[held == e].max(initial=0)) for e in range(k)]) + np.sqrt(((new - old.entries) ** 2).sum(axis=1))
    balls = bc.Balls(new, radius)
    want, got = balls.nearest(parts), balls.moved(parts, held)
    assert (want[0] == got[0]).all() and (want[1] == got[1]).all()


def test_cores_and_rings_save_work():
    rng = np.random.default_rng(1)
    cells = np.floor(made(rng, 20_000, 16, 0.05, 40)[:, :4] * 1024).astype(np.float64)
    old = bc.Balls(cells[:256])
    held, far = old.nearest(cells)
    new = np.array([np.floor(cells[held == e].mean(axis=0)) if (held == e).any() else old.entries[e] for e in range(256)])
    radius = np.array([np.sqrt(far[held == e].max(initial=0)) for e in range(256)]) + np.sqrt(((new - old.entries) ** 2).sum(axis=1))
    assert bc.Balls(new, radius).moved(cells, held)[2] < 0.25 * 256 * len(cells)
