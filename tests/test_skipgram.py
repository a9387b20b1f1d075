import numpy as np
from pyspark.ml import feature
from pyspark.sql import functions as F

from paperloom.models import embeddings as E, skipgram as S

SUBJECTS = (["star", "galaxy", "dust"], ["gene", "cell", "protein"])
DOCS = [(i, [SUBJECTS[i % 2][(i * 7 + k * k + k) % 3] for k in range(12)]) for i in range(60)]


def test_words_are_trained_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "SAMPLES", 2)  # so that six words make three blocks
    monkeypatch.setattr(feature.Word2Vec, "fit", lambda *a: 1 / 0)  # keeps all parameters on the driver
    tokens = spark.createDataFrame(DOCS, "doc_id int, tokens array<string>")
    model = E.train_words(tokens, width=16, window=3, min_count=1, iterations=8, partitions=3, seed=1)
    again = E.train_words(tokens.repartition(5), width=16, window=3, min_count=1, iterations=8, partitions=3, seed=1)
    first, second = ({r.word: r.vector for r in E.word_table(m).collect()} for m in (model, again))
    assert first.keys() == {w for s in SUBJECTS for w in s}
    assert all(np.isfinite(v).all() and len(v) == 16 for v in first.values())
    assert all(np.allclose(first[w], second[w], atol=1e-3) for w in first)
    for subject in SUBJECTS:
        assert {r.word for r in E.neighbours(model, subject[0], 2).collect()} == set(subject[1:])


def test_pairs_are_counted_by_cells(spark):
    lists = spark.createDataFrame([([0, 1, 2, 0],), ([3],), ([],), (None,), ([1, 1],)], "ids array<int>")
    got = {}
    for r in S.cells_of(lists, 2, 4, 2).collect():
        block, shift = divmod(r.cell, 2)
        for a, b, w in zip(np.frombuffer(r.a, np.int32), np.frombuffer(r.b, np.int32), np.frombuffer(r.w, np.float32)):
            key = (int(a) * 2 + block, int(b) * 2 + (block + shift) % 2)
            got[key] = got.get(key, 0) + float(w)
    # neighbours weigh 1, words two apart 1/2; a pair counts from both sides
    assert got == {(0, 1): 1.5, (1, 0): 1.5, (0, 2): 1.5, (2, 0): 1.5, (1, 2): 1.0, (2, 1): 1.0, (1, 1): 2.0}


def test_a_corpus_of_single_words(spark):
    tokens = spark.createDataFrame([(1, ["a"]), (2, ["b"]), (3, None)], "doc_id int, tokens array<string>")
    words = E.word_table(E.train_words(tokens, width=4, min_count=1, iterations=1, partitions=2))
    assert sorted(r.word for r in words.collect()) == ["a", "b"]
    assert words.filter(F.exists("vector", F.isnan)).count() == 0


def test_pairs_are_coded():
    key = np.cumsum(np.random.default_rng(0).integers(0, 300, 100_000)) + (1 << 40)
    weight = np.random.default_rng(1).integers(1, 9, len(key))
    data = S.pack_pairs(key, weight)
    assert all((x == y).all() for x, y in zip(S.unpack_pairs(data), (key, weight)))
    assert len(data) < 3 * len(key)  # 12 bytes a pair as plain numbers
    assert all(len(x) == 0 for x in S.unpack_pairs(S.pack_pairs(key[:0], weight[:0])))


def test_a_step_equals_a_loop(monkeypatch):
    """Dense products for frequent words and products of a few rows at a time give what single pairs give."""
    random = np.random.default_rng(3)
    mine, other = (random.normal(size=(n, 6)).astype(np.float32) for n in (70, 150))
    key = np.unique((70 * random.random(3000) ** 3).astype(int) * 150 + (150 * random.random(3000) ** 3).astype(int))
    a, b, w = key // 150, key % 150, random.random(len(key)).astype(np.float32)
    mass, odds = random.random(70), random.random(150)
    of = lambda x: 1 / (1 + np.exp(-x))
    grad = -(of(mine @ other.T) * mass[:, None] * odds / odds.sum()) @ other
    for i, j, x in zip(a, b, w):
        grad[i] += x * (1 - of(mine[i] @ other[j])) * other[j]
    squares = (grad ** 2).mean(axis=1)
    want = mine + S.RATE / np.sqrt(squares)[:, None] * grad
    for cost, few, size in ((24, 2400, 512 << 10), (1e-9, 18, 1600), (1e9, 2400, 512 << 10)):
        monkeypatch.setattr(S, "PAIR_COST", cost)
        monkeypatch.setattr(S, "FEW_CELLS", few)
        monkeypatch.setattr(S, "SLICE_BYTES", size)
        got, summed = mine.copy(), np.zeros(70, np.float32)
        S.move(got, summed, mass, other, odds, a, b, w, 256, random)
        assert np.allclose(got, want, atol=1e-4) and np.allclose(summed, squares, rtol=1e-3)


def test_no_parameters_are_shuffled(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(S, "SAMPLES", 2)
    runs = []
    monkeypatch.setattr(S, "run_tasks", lambda df: (runs.append(df._jdf.queryExecution().executedPlan().toString()), df.write.format("noop").mode("overwrite").save()))
    tokens = spark.createDataFrame(DOCS, "doc_id int, tokens array<string>")
    E.words_or_train(tokens, str(tmp_path), width=4, window=3, min_count=1, iterations=2, partitions=3, seed=1)
    assert len(runs) == 6  # pairs, counts, and two moves an iteration
    assert not any("Exchange" in plan for plan in runs[2:])


def test_words_too_many_for_a_task_are_joined(spark, monkeypatch):
    tokens = spark.createDataFrame([(1, ["b", "a", "z", "b"]), (2, ["a", None]), (3, None)], "doc_id int, tokens array<string>").coalesce(1)
    ids = spark.createDataFrame([("a", 0), ("b", 1)], "token string, id long")
    held = [r.ids for r in S.id_lists(tokens, ids).collect()]
    monkeypatch.setattr(S, "TABLE_ROWS", 1)
    assert held == [[1, 0, 1], [0], []] and sorted(r.ids for r in S.id_lists(tokens, ids).collect()) == [[0], [1, 0, 1]]
