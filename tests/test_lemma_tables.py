"""Words get their lemmas where the rows are read, whatever the rows are."""

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.operators import lemmas as L
from paperloom.session import staged
from tests.test_in_place import exchanges

ROWS = [(1, ["cats", "cat", None, "cats", "dogs"]), (2, []), (3, None), (4, ["x"]), (5, [None]), (None, ["cats"]), (6, ["é", "dogs", ""])]
LEMMAS = [("cats", "cat"), ("dogs", "dog"), ("é", "e"), ("mice", "mouse"), ("x", None), (None, "y")]


def tables(spark):
    return (staged(spark.createDataFrame(ROWS, "doc_id long, tokens array<string>").withColumn("lang", F.lit("l")).repartition(2), "rows"),
            staged(spark.createDataFrame(LEMMAS, "word string, lemma string"), "lemmas"))


@pytest.mark.parametrize("fits", [True, False])
def test_words_and_lemmas(spark, monkeypatch, fits):
    if not fits:
        monkeypatch.setattr(L, "fits_broadcast", lambda *a: False)
    frame = L.lemmatise(*tables(spark))
    assert frame.columns == ["doc_id", "tokens", "lang"]
    got = {r.doc_id: r.tokens for r in frame.collect()}
    assert got == {1: ["cat", "cat", None, "cat", "dog"], 2: [], 3: None, 4: ["x"], 5: [None], None: ["cats"], 6: ["e", "dog", ""]}


def test_no_lemmas(spark):
    tokens, lemmas = tables(spark)
    got = L.lemmatise(tokens, staged(lemmas.limit(0), "none")).collect()
    assert sorted(map(str, got)) == sorted(map(str, tokens.collect()))


def test_no_row_for_each_word(spark):
    """No words are exploded, no map is made per document, and a filter does not have the words replaced twice."""
    frame = L.lemmatise(*tables(spark))
    assert not exchanges(frame)
    text = frame.filter(F.size("tokens") > 0)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and text.count("ArrowEvalPython") == 1


def test_stop_free_words_are_cut_once(spark):
    rows = [(" The,  the Cat-s … a.b　!!\t'the'\n x\x1cy\x85z ",), ("",), (None,), ("!? the",)]
    frame = spark.createDataFrame(rows, "text string").select(T.stop_free_words("text", ["the"]).alias("w"))
    assert [r.w for r in frame.collect()] == [["the", "cats", "…", "ab", "the", "x", "y", "z"], [], None, []]
    assert frame._jdf.queryExecution().executedPlan().toString().count("split(") == 1
