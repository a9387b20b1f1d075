import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.models import embeddings as E, layout as Y, topics
from paperloom.operators import bow, grid, reconcile, similarity as S, windows
from paperloom.plans import analyse

DOCS = [
    (f"d{i}", (["star", "galaxy", "dust"] if i % 2 else ["gene", "cell", "protein"]) * (2 + i % 3))
    for i in range(40)
]


@pytest.fixture(scope="module")
def tokens(spark):
    return spark.createDataFrame(DOCS, "doc_id string, tokens array<string>")


def test_topics_separate_the_subjects(spark, tokens, tmp_path):
    vectorizer, vectors = topics.count_vectors(tokens)
    assert len(vectorizer.vocabulary) == 6
    model = topics.train_topics(vectors, k=2, passes=4, seed=3, subsampling=0.5)
    terms = topics.topic_terms(model, topics.vocabulary_table(spark, vectorizer), 3).collect()
    sets = {frozenset(r.term for r in terms if r.topic == k) for k in (0, 1)}
    assert sets == {frozenset({"star", "galaxy", "dust"}), frozenset({"gene", "cell", "protein"})}
    mixed = model.transform(vectors).select("topicDistribution").collect()
    assert all(math.isclose(sum(r[0]), 1, abs_tol=1e-6) for r in mixed)
    topics.save_model(model, str(tmp_path / "lda"))
    assert topics.load_topics(str(tmp_path / "lda")).vocabSize() == 6
    assert analyse.topic_report(tokens, k=2, passes=1, terms=2).count() == 4


def test_spread_topics_hold_no_vocabulary_on_the_driver(spark, tokens, monkeypatch, tmp_path):
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: pytest.fail("a table was made of driver rows"))
    got = topics.corpus_topics(tokens, k=2, passes=30, n=3, seed=3).collect()
    sets = {frozenset(r.term for r in got if r.topic == k) for k in (0, 1)}
    assert sets == {frozenset({"star", "galaxy", "dust"}), frozenset({"gene", "cell", "protein"})}
    model, vocab = topics.train_corpus_topics(tokens, 2, 5, seed=3, min_df=2)
    assert vocab.count() == 6
    topics.save_model(model, str(tmp_path / "em"))
    assert topics.load_topics(str(tmp_path / "em"), spread=True).vocabSize() == 6


def test_word_and_document_vectors(spark, tokens, tmp_path):
    path = str(tmp_path / "w2v")
    model = E.words_or_train(tokens, path, width=8, window=2, min_count=1, iterations=5, seed=1)
    again = E.words_or_train(tokens, path)
    assert again.getVectors().count() == model.getVectors().count() == 6
    near = [r.word for r in E.neighbours(model, "star", 5).collect()]
    assert len(near) == 5 and "star" not in near
    words = E.word_table(model)
    joined = {r.doc_id: r.vector for r in E.document_vectors(tokens, words).collect()}
    inferred = {r.doc_id: r.vector for r in E.infer_vectors(model, tokens).collect()}
    assert all(np.allclose(joined[k], inferred[k], atol=1e-5) for k in inferred)
    unseen = spark.createDataFrame([("u", ["nothing"])], "doc_id string, tokens array<string>")
    assert E.document_vectors(unseen, words).first().vector is None
    weighted = E.document_vectors(tokens, words, weights=E.idf_weights(tokens))
    assert weighted.count() == 40


VECTORS = [("a", [1.0, 0.0, 2.0]), ("twin", [2.0, 0.0, 4.0]), ("far", [-1.0, 0.0, -2.0]),
           ("side", [0.0, 3.0, 0.0]), ("zero", [0.0, 0.0, 0.0])]


def test_similarity(spark):
    table = spark.createDataFrame(VECTORS, "doc_id string, vector array<double>")
    far = {r.doc_id: r.distance for r in S.distances(table, S.query_vector(table, "a")).collect()}
    assert abs(far["a"]) < 1e-12 and abs(far["twin"]) < 1e-12 and abs(far["far"] - 2) < 1e-12
    assert far["side"] == 1.0 and math.isnan(far["zero"])
    near = S.nearest(table, "a", 4).collect()
    assert [r.doc_id for r in near] == ["twin", "side", "far", "zero"]
    points = Y.layout(table)
    assert S.neighbourhood(table, "a", points, 2, key="doc_id").count() == 3
    xy = np.array([[r.x, r.y] for r in points.orderBy("doc_id").collect()])
    data = np.array([v for _, v in sorted(VECTORS)])
    centred = data - data.mean(0)
    # the projection keeps as much variance as the two leading axes have
    leading = np.sort(np.linalg.eigvalsh(np.cov(centred.T)))[::-1][:2].sum()
    assert math.isclose(np.cov(xy.T).trace(), leading, rel_tol=1e-9)


def test_grid_edges(spark):
    rows = [(0.0, 0.0, "a"), (1.0, 1.0, "a"), (0.5, 0.5, "b"), (float("nan"), 0.2, "b"), (None, 0.1, "c")]
    points = spark.createDataFrame(rows, "x double, y double, category string")
    got = {(r.px, r.py): r.cnt for r in grid.grid_counts(points, 4, 4).collect()}
    assert got == {(0, 0): 1, (3, 3): 1, (2, 2): 1}
    flat = spark.createDataFrame([(1.0, 1.0)] * 3, "x double, y double")
    cells = grid.grid_counts(flat, 4, 4)
    assert [(r.px, r.py, r.cnt) for r in cells.collect()] == [(0, 0, 3)]
    assert [r.shade for r in windows.linear_shade(cells).collect()] == [0.0]
    assert [r.shade for r in windows.equalise(cells).collect()] == [1.0]
    top = grid.grid_by_category(points, top=1, width=2, height=2)
    assert {(r.px, r.py, r.category) for r in top.collect()} == {(0, 0, "a"), (1, 1, "a")}
    index = {r.category: r.category_index for r in grid.category_index(points).collect()}
    assert index == {"a": 0, "b": 1, "c": 2}


def test_density_plan(spark):
    vectors = spark.createDataFrame([(f"p{i}", [float(i), float(i % 3), 1.0]) for i in range(30)], "doc_id string, vector array<double>")
    records = spark.createDataFrame([(f"p{i}", "a b" if i % 2 else "c") for i in range(25)], "filename_parsed string, categories string")
    cells = analyse.density_by_category(vectors, records, top=2, width=5, height=5)
    assert cells.agg(F.sum("cnt")).first()[0] == 25
    assert reconcile.corpus_categories(records, vectors).count() == 25


def test_bow_drops_unknown_tokens(spark, tokens):
    counts = bow.term_counts(tokens)
    vocab = bow.vocabulary(counts).filter("term <> 'star'")
    total = counts.agg(F.sum("cnt")).first()[0]
    kept = bow.bag_of_words(counts, vocab).agg(F.sum("cnt")).first()[0]
    stars = counts.filter("token = 'star'").agg(F.sum("cnt")).first()[0]
    assert kept == total - stars


def test_phrase_query_trains_at_the_defaults(spark, monkeypatch):
    from paperloom.queries import models

    asked = {}

    def stop(tokens, **settings):
        asked.update(settings)
        raise InterruptedError

    monkeypatch.setattr(models, "stored_tokens", lambda t: None)
    monkeypatch.setattr(models, "phrase_words", stop)
    with pytest.raises(InterruptedError):
        models.phrase_word_vectors(None)
    assert asked.keys() <= {"partitions", "seed"}  # width, window and iterations are those of phrase_words
