import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.llm import periodic_runs as pr
from paperloom.llm import queries as Q
from tests.llm.helpers import awkward, docs


def brute_runs(words, least):
    """All maximal stretches by period, smallest period first."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            stretch = words[i:j + q]
            if len(stretch) >= max(least, 2 * q) and all(any(a != b for a, b in zip(stretch, stretch[r:])) for r in range(1, q)):
                found.append((i, len(stretch), q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def found(texts, least):
    own = [[] for _ in texts]
    for d, *run in zip(*(x.tolist() for x in pr.runs_of([[w.encode() for w in t] for t in texts], least))):
        own[d].append(tuple(run))
    return own


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), max_size=4), st.integers(2, 13))
def test_runs_of_random_words(texts, least):
    assert found(texts, least) == [brute_runs(t, least) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("ab"), min_size=1, max_size=7), st.integers(1, 12), st.lists(st.sampled_from("abc"), max_size=15), st.integers(1, 5))
def test_nested_runs(piece, times, tail, again):
    words = (piece * times + tail) * again
    assert found([words, words[::-1], piece], 12) == [brute_runs(w, 12) for w in (words, words[::-1], piece)]


def test_long_runs_of_one_word_and_of_many():
    rng = random.Random(4)
    many = [str(rng.randrange(10**6)) for _ in range(7000)]
    assert found([["a"] * 50_000, many * 5, many], 12) == [[(0, 50_000, 1)], [(0, 35_000, 7000)], []]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(2)
    rows = awkward()
    for k in range(60):
        words = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 90))]
        rows.append((100 + k, " \t".join(words) + "\x1c é " * (k % 3)))
    return docs(spark, rows, clashing=True).withColumn("runs", F.lit(1)), rows


def test_awkward_rows(table):
    frame, rows = table
    got = pr.find_runs(frame).select("doc_id", "n_words", "runs", "collapsed", "own", "key").collect()
    assert len(got) == len(rows)
    want = []
    for doc_id, text in (r[:2] for r in rows):
        words = [w.decode() for w in (text or "").encode().split()]
        runs = brute_runs(words, 12) if len(words) < 3000 else None
        want.append((doc_id, len(words), runs, None if runs is None else brute_collapsed(words, runs)))
    for row, (doc_id, n, runs, left) in zip(got, want):
        assert (row.doc_id, row.n_words) == (doc_id, n) and row.own == row.key == "src"
        if runs is not None:
            assert ([tuple(r) for r in row.runs], row.collapsed) == (runs, left)


def test_empty_table(spark):
    assert pr.find_runs(docs(spark, [])).count() == 0


def test_query_against_brute_force(spark, tmp_path):
    import hashlib
    import zlib

    rng = random.Random(7)
    rows = [(k, " ".join(rng.choice("abcdef") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 120)))) for k in range(300)] + [(None, "a b " * 9), (301, None)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in Q.queries()["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    looped = 0
    for doc_id, text in rows:
        words = (text or "").split()
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            looped += 1
        runs = brute_runs(words, 12)
        row = got[doc_id]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert (row.start, row.length, row.period) == (best or (None,) * 3) and row.n_runs == len(runs)
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
    assert looped > 10
