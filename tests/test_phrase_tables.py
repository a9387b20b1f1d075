"""Phrases are found and merged where the rows are read, whatever the rows are; pairs are counted by whole numbers."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.operators import phrases as P, word_codes as W
from paperloom.session import staged
from tests.test_in_place import exchanges

SCHEMA = "doc_id long, tokens array<string>, lang string"
ROWS = [
    (1, ["a", "b", "c", "a", "b"], "x"), (2, ["a", "a", "b", "b"], "x"), (3, [], "x"), (4, None, "x"), (5, ["b"], "x"),
    (6, ["a", None, "b", "a", "b"], "x"), (7, ["a", None, "b"], "x"), (8, ["b", "c", "a", "a", "a"], "y"), (9, ["a"], "y"),
    (10, ["b", "z", "é", "é", "é", "é"], None), (None, ["a", "b"], "n"),
]
REPEATED = [(1, ["a", "b"], "r"), (1, ["c", "a", "b", "a", "b"], "r"), (None, ["c", "a", "b"], "r")]
PAIRS = [("a", "b"), ("b", "c"), ("a", "a"), ("é", "é"), ("nowhere", "a"), (None, "b")]


def tables(spark, rows):
    return (staged(spark.createDataFrame(rows, SCHEMA).repartition(2), "rows"),
            staged(spark.createDataFrame([(*p, 1.0) for p in PAIRS], "left string, right string, score double"), "phrases"))


def taken(frame):
    return sorted(str(tuple(r)) for r in frame.collect())


@pytest.mark.parametrize("rows", [ROWS, ROWS + REPEATED])
def test_both_ways_agree(spark, monkeypatch, rows):
    """Sent to every task or joined: the same documents and the same report, for null and repeated keys as well."""
    tokens, phrases = tables(spark, rows)
    merged, report = taken(P.apply_phrases(tokens, phrases)), taken(P.phrase_report(tokens, phrases))
    assert P.apply_phrases(tokens, phrases).columns == ["doc_id", "tokens", "lang"]
    monkeypatch.setattr(P, "_phrase_table", lambda *a: None)
    assert merged == taken(P.apply_phrases(tokens, phrases))
    assert report == taken(P.phrase_report(tokens, phrases))


def test_merged_documents(spark):
    got = {r.doc_id: r.tokens for r in P.apply_phrases(*tables(spark, ROWS)).collect()}
    assert got[1] == ["a_b", "c", "a_b"] and got[2] == ["a_a", "b", "b"] and got[3] == [] and got[4] is None
    assert got[6] == ["a", "b", "a_b"] and got[7] == ["a", None, "b"] and got[8] == ["b_c", "a_a", "a"]
    assert got[10] == ["b", "z", "é_é", "é_é"] and got[None] == ["a", "b"]


def test_no_row_for_each_pair(spark):
    """The plans neither explode pairs nor shuffle documents, and a filter does not have them rewritten twice."""
    tokens, phrases = tables(spark, ROWS)
    frame = P.apply_phrases(tokens, phrases)
    assert not exchanges(frame)
    for plan in (frame.filter(F.size("tokens") > 0), P.phrase_report(tokens, phrases)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in text and text.count("ArrowEvalPython") <= 1


@pytest.mark.parametrize("same_hash", [False, True])
@pytest.mark.parametrize("threshold", [-100.0, 0.01])
def test_scores_do_not_depend_on_hashes(spark, monkeypatch, same_hash, threshold):
    tokens, _ = tables(spark, ROWS + REPEATED)
    words, pairs = {}, {}
    for _, ws, _ in ROWS + REPEATED:
        for w in filter(None, ws or []):
            words[w] = words.get(w, 0) + 1
        for p in zip(ws or [], (ws or [])[1:]):
            pairs[p] = pairs.get(p, 0) + 1
    want = {p: (n - 1) / words[p[0]] / words[p[1]] * (len(words) + len(pairs)) for p, n in pairs.items() if None not in p}
    if same_hash:  # as if two words shared one
        monkeypatch.setattr(P, "word_hash", lambda *a: F.lit(7).cast("bigint"))
        monkeypatch.setattr(P, "pair_hash_counts", None)
    else:
        monkeypatch.setattr(P, "pair_counts", None)
    got = {(r.left, r.right): (r.cnt, r.score) for r in P.phrase_scores(tokens, min_count=1, threshold=threshold).collect()}
    assert got.keys() == {p for p, score in want.items() if score > threshold}
    assert all(n == pairs[p] and abs(score - want[p]) < 1e-9 for p, (n, score) in got.items())


def test_no_text_at_all(spark):
    tokens, _ = tables(spark, [(1, None, "x"), (2, [], "x")])
    assert P.phrase_scores(tokens).count() == 0
    merged, _ = P.detect_ngrams(tokens)
    assert taken(merged.select("doc_id")) == ["(1,)", "(2,)"]


@pytest.mark.parametrize("same_hash", [False, True])
def test_places_of_words(monkeypatch, same_hash):
    if same_hash:
        monkeypatch.setattr(W, "hashes", lambda words: np.zeros(len(words), np.int64))
    table = W.WordTable(pa.array(["b", "", "a\0", "é"]))
    asked = pa.array(["a", "é", "b", "x", "", "a\0"])
    got = table.places(asked)
    assert [None if at < 0 else table.words[int(at)].as_py() for at in got] == [None, "é", "b", None, "", "a\0"]
    assert list(W.WordTable(pa.array([], pa.string())).places(asked)) == [-1] * 6
    assert len(table.places(pa.array([], pa.string()))) == 0


def test_words_have_hashes_of_their_own():
    assert len(set(W.hashes(pa.array([f"w{i}" for i in range(10000)])))) == 10000
