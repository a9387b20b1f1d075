"""Words are counted where their rows are read, and only rarer terms are shuffled to their ids."""

import pytest

from paperloom.operators import bow as B
from paperloom.session import staged
from tests.test_in_place import exchanges

ROWS = [(1, ["b", "a", "b", None]), (2, []), (3, None), (None, ["z"]), (4, ["a"] * 3 + ["c"])]
COUNTS = {(1, "a", 1), (1, "b", 2), (None, "z", 1), (4, "a", 3), (4, "c", 1)}


def table(spark, rows):
    return staged(spark.createDataFrame(rows, "doc_id long, tokens array<string>"), "rows")


@pytest.mark.parametrize("count", [B.term_counts, B.sorted_term_counts])
def test_counts_do_not_move(spark, count):
    frame = count(table(spark, ROWS))
    assert not exchanges(frame)
    assert {tuple(r) for r in frame.select("doc_id", "token", "cnt").collect()} == COUNTS


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("count", [B.term_counts, B.sorted_term_counts])
def test_documents_of_several_rows_are_added_up(spark, monkeypatch, count, small):
    if not small:
        monkeypatch.setattr(B, "fits_broadcast", lambda *a: False)
    got = count(table(spark, [*ROWS, (1, ["a", "d"]), (None, ["z", "y"])])).select("doc_id", "token", "cnt").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, (COUNTS - {(1, "a", 1), (None, "z", 1)})
                                                           | {(1, "a", 2), (1, "d", 1), (None, "z", 2), (None, "y", 1)}))


def test_order_within_a_document(spark):
    rows = B.sorted_term_counts(table(spark, [(1, list("zzaebbé")), (2, list("ba"))])).collect()
    assert [tuple(r) for r in rows if r.doc_id == 1] == [(1, "a", 1), (1, "e", 1), (1, "é", 1), (1, "b", 2), (1, "z", 2)]
    assert [tuple(r) for r in rows if r.doc_id == 2] == [(2, "a", 1), (2, "b", 1)]


@pytest.mark.parametrize("most", [0, 1, 2, 100])
def test_ids_of_common_and_rare_terms(spark, monkeypatch, most):
    monkeypatch.setattr(B, "BROADCAST_ROWS", most)
    counts = staged(B.term_counts(table(spark, ROWS)), "counts")
    vocab = staged(B.vocabulary(counts), "vocabulary")
    ids = {r.term: r.term_id for r in vocab.collect()}
    frame = B.bag_of_words(counts, vocab)
    assert {tuple(r) for r in frame.collect()} == {(d, ids[t], n) for d, t, n in COUNTS}
    assert B._common_floor(vocab) == (0 if most == 100 else 1 if most else 2)
