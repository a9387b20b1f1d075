import numpy as np
import pytest

from paperloom.llm import rotated_codes as codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, ids, vectors):
    rows = [(int(i) if i is not None else None, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(ids, vectors, asked, k):
    ids, out = np.array(ids), []
    vectors = np.array(vectors, np.float32).astype(float)
    for q in asked:
        own = vectors[ids == q][0]
        distance = np.sqrt(((vectors - own) ** 2).sum(axis=1))
        other = np.flatnonzero(ids != q)
        order = other[np.lexsort((ids[other], distance[other]))][:k]
        out += [(q, r + 1, int(ids[x])) for r, x in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("block, spread", [(16_384, 1.0), (100, 0.05)])
def test_recall(spark, monkeypatch, block, spread):
    monkeypatch.setattr(codes, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((10, 32))
    vectors = centres[rng.integers(0, 10, 1500)] + spread * rng.standard_normal((1500, 32))
    table = frame(spark, range(1500), vectors)
    got = {(r.query_id, r.rank, r.vec_id) for r in codes.nearest(table, table.where("vec_id % 50 = 0")).collect()}
    want = set(brute(range(1500), vectors, range(0, 1500, 50), 10))
    assert len(got) == len(want) and len(got & want) >= 0.99 * len(want)


def test_bounds_hold_for_nearly_all():
    rng = np.random.default_rng(1)
    data, queries = rng.standard_normal((2000, 64)), rng.standard_normal((50, 64))
    centre = data.mean(axis=0)
    guess, low = codes.estimate(*codes.encode(data, centre, codes.rotation(64)), queries, centre, codes.rotation(64))
    true = ((data[:, None] - queries[None]) ** 2).sum(axis=2)
    assert (low <= true + 1e-6).mean() > 0.999
    assert np.corrcoef(guess.ravel(), true.ravel())[0, 1] > 0.75


def test_ties_and_copies(spark):
    vectors = [[1.0, 0.0]] * 40 + [[0.0, 1.0]]
    out = codes.nearest(frame(spark, range(41), vectors), frame(spark, [40, 0], [[0.0, 1.0], [1.0, 0.0]]), 5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in out) == [(0, k, k) for k in range(1, 6)] + [(40, k + 1, k) for k in range(5)]


def test_copies_of_one_id_do_not_crowd_others_out(spark):
    """50 rows of one id that equal the query's vector under another id: nine other ids are found all the same."""
    rng = np.random.default_rng(11)
    near = rng.standard_normal(16)
    others = rng.standard_normal((60, 16)) * 3
    ids = [0] + [1] * 50 + list(range(2, 62))
    vectors = np.concatenate([[near] * 51, others])
    table = frame(spark, ids, vectors)
    got = sorted((r.query_id, r.rank, r.vec_id) for r in codes.nearest(table, table.where("vec_id = 0")).collect())
    once = [0, *range(50, 111)]
    assert got == brute([ids[k] for k in once], vectors[once], [0], 10)


def test_rows_that_stand_several_times(spark):
    rng = np.random.default_rng(12)
    vectors = rng.standard_normal((300, 16))
    ids = list(range(300)) * 12
    table, asked = frame(spark, ids, np.concatenate([vectors] * 12)), frame(spark, range(0, 300, 30), vectors[::30])
    got = {(r.query_id, r.rank, r.vec_id) for r in codes.nearest(table, asked).collect()}
    want = set(brute(range(300), vectors, range(0, 300, 30), 10))
    assert len(got) == len(want) and len(got & want) >= 0.99 * len(want)


def test_awkward_rows(spark):
    ids = [1, 2, 3, 4, 5, 6, 7, None, 8, 8, 9]
    vectors = [[1, 2], None, [], [0, 0], [None, 1], [float("nan"), 1], [float("inf"), 1], [1, 1], [3, 4], [3, 5], [1, 2, 3]]
    table = frame(spark, ids, vectors)
    out = sorted(map(tuple, codes.nearest(table, table).select("query_id", "rank", "vec_id").collect()))
    assert out == [(1, 1, 8), (8, 1, 1)]
    empty = frame(spark, [], [])
    assert codes.nearest(empty, empty).count() == 0
    assert codes.nearest(table, empty).count() == 0
