import numpy as np
from pyspark.ml import clustering

from paperloom.models import spread_topics as S, topics

COUNTS = [(d, t, 1 + (d * t) % 3) for d in range(12) for t in range(9) if t % 3 == d % 3 or (d + t) % 5 == 0]


def loop(start, passes, k, terms, c=1.1):
    """Passes of the same rules over single counts, from topics given for each."""
    def sums(gamma):
        of_doc, of_term = np.zeros((12, k)), np.zeros((terms, k))
        for (d, t, n), g in zip(COUNTS, gamma):
            of_doc[d] += n * g / g.sum()
            of_term[t] += n * g / g.sum()
        return of_doc, of_term

    of_doc, of_term = sums(start)
    for _ in range(passes):
        totals = of_doc.sum(axis=0)
        of_doc, of_term = sums([(of_term[t] + c - 1) * (of_doc[d] + c - 1) / (totals + (c - 1) * terms) for d, t, _ in COUNTS])
    return of_term


def test_passes_over_blocks_equal_a_loop(spark, monkeypatch):
    monkeypatch.setattr(clustering.LDA, "fit", lambda *a: 1 / 0)  # a graph of all documents and terms
    for name, value in (("BLOCK_COUNTS", 9), ("FEW_COUNTS", 4), ("RANGE_TERMS", 4), ("SLICE", 5)):
        monkeypatch.setattr(S, name, value)
    bag = spark.createDataFrame(COUNTS, "doc_id int, term_id long, cnt long")
    first = {r.term_id: r.weights for r in S.train(bag, 9, 2, 0, seed=1).table.collect()}
    total = sum(n for *_, n in COUNTS)
    assert first.keys() == set(range(9)) and np.isclose(sum(map(sum, first.values())), total)
    third = {r.term_id: r.weights for r in S.train(bag, 9, 1, 3, seed=1).table.collect()}
    want = loop(np.ones((len(COUNTS), 1)), 3, 1, 9)
    assert all(np.allclose(third[t], want[t]) for t in range(9))


def test_one_pass_follows_the_rules():
    import pyarrow as pa

    docs = pa.table({"block": [7, 7], "doc": [0, 1], "terms": [[3, 1], [1]], "counts": [[2, 1], [4]]})
    state = [r for rows in (S._rows(7, 7, "own", np.arange(2), np.array([[2.0, 1.0], [1.0, 3.0]])),
                            S._rows(7, 0, "terms", np.array([1, 3]), np.array([[4.0, 1.0], [1.0, 2.0]]))) for r in rows]
    out = S._pass(2, 0, 5, [5.0, 3.0], 1.1, 100, 2)(docs, S._table(state)).to_pylist()
    got = {r["kind"]: np.frombuffer(r["data"]).reshape(-1, 2) for r in out}
    below = np.array([5.5, 3.5])
    of = lambda w, d: (np.array(w) + 0.1) * (np.array(d) + 0.1) / below / ((np.array(w) + 0.1) * (np.array(d) + 0.1) / below).sum()
    a, b, c = of([1, 2], [2, 1]) * 2, of([4, 1], [2, 1]), of([4, 1], [1, 3]) * 4
    assert np.allclose(got["own"], [a + b, c]) and np.allclose(got["terms"], [b + c, a]) and np.allclose(got["total"], [a + b + c])


def test_a_stored_model_comes_back(spark, tmp_path):
    bag = spark.createDataFrame(COUNTS, "doc_id int, term_id long, cnt long")
    model = topics.train_spread_topics(bag, 9, 3, 4)
    topics.save_model(model, str(tmp_path / "m"))
    back = topics.load_topics(str(tmp_path / "m"), spread=True)
    described = back.describeTopics(4).collect()
    assert back.vocabSize() == 9 and len(described) == 3
    assert all(len(r.termIndices) == 4 and sorted(r.termWeights, reverse=True) == r.termWeights for r in described)


def test_terms_are_numbered():
    for ids in ([7, 3, 3, 9, 0, 7], [5], []):
        names, place = S._numbered(np.array(ids, np.int64))
        want = np.unique(np.array(ids, np.int64), return_inverse=True)
        assert names.tolist() == want[0].tolist() and place.tolist() == want[1].tolist()


def test_totals_come_in_one_job_a_pass(spark, monkeypatch):
    bag = spark.createDataFrame(COUNTS, "doc_id int, term_id long, cnt long")
    monkeypatch.setattr(type(bag), "toLocalIterator", lambda *a, **k: 1 / 0)  # a job for each block
    assert S.train(bag, 9, 2, 1, seed=1).vocabSize() == 9
