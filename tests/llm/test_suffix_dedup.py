import collections
import hashlib
import random

import numpy as np
import pytest

from paperloom.llm import suffix_dedup as dedup
from paperloom.llm.queries import op2_suffix_dedup
from tests.llm.helpers import awkward, docs, sentence


def brute(texts, window):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[k:k + window] for b in raw for k in range(len(b) - window + 1))
    out = []
    for b in raw:
        cover = np.zeros(len(b) + 1, int)
        for k in range(len(b) - window + 1):
            if seen[b[k:k + window]] > 1:
                cover[k] += 1
                cover[k + window] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        out.append((len(b), int(gone.sum()), bytes(x for x, y in zip(b, gone) if not y)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    shared = [sentence(rng, n) for n in (25, 40, 60, 200)]
    texts = []
    for k in range(60):
        parts = [sentence(rng, rng.randint(0, 80)) for _ in range(rng.randint(1, 3))]
        if rng.random() < 0.6:
            part = rng.choice(shared)
            cut = rng.randint(0, 30)
            parts.insert(rng.randint(0, len(parts)), part[cut:] if rng.random() < 0.5 else part)
        texts.append(" ".join(parts))
    near = sentence(rng, 150)
    for k in range(8):
        at = rng.randint(0, len(near))
        texts.append(near[:at] + "X" * rng.randint(0, 3) + near[at + 1:])
    return texts


@pytest.mark.parametrize("seed, crowd", [(1, 1000), (2, 1000), (3, 1), (4, 0)])
def test_against_all_windows(spark, monkeypatch, seed, crowd):
    monkeypatch.setattr(dedup, "CROWD", crowd)  # 1 and 0: phrases are cut into bands
    texts = corpus(seed) + [t for _, t in awkward()[:5]] + ["ab" * 300, "ab" * 300 + "c", "é" * 150, "x" + "é" * 150]
    got = {r.doc_id: (r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), bytes(r.kept))
           for r in dedup.find_repeats(docs(spark, list(enumerate(texts)), clashing=True)).collect()}
    assert got == dict(enumerate(brute(texts, 200)))


def near_copies(n):
    rng = random.Random(n)
    words = sentence(rng, 150).split()
    texts = []
    for _ in range(n):
        own = list(words)
        for k in rng.sample(range(len(own)), 2):
            own[k] = sentence(rng, 1)
        texts.append(" ".join(own))
    return texts


def test_rows_grow_with_a_group_of_near_copies(spark, monkeypatch):
    """The rows found grow in proportion, on both sides of the number from which phrases are cut into bands."""
    made = {}
    found = dedup.shared_windows

    def counted(entries, window):
        rows = found(entries, window)
        made["runs"] = rows.count()
        return rows

    monkeypatch.setattr(dedup, "shared_windows", counted)
    rows = {}
    for n in (500, 2000):
        texts = near_copies(n)
        got = {r.doc_id: (r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), bytes(r.kept))
               for r in dedup.find_repeats(docs(spark, list(enumerate(texts)))).collect()}
        assert got == dict(enumerate(brute(texts, 200)))
        rows[n] = made["runs"]
    assert rows[2000] <= 6 * rows[500]


def test_segments_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SEGMENT", 500)
    texts = corpus(5)
    found = {}
    for row in dedup.find_repeats(docs(spark, list(enumerate(texts)))).collect():
        found[row.doc_id] = (row.n_bytes, sum(s["end"] - s["start"] for s in row.spans), bytes(row.kept))
    assert found == dict(enumerate(brute(texts, 200)))


def test_repeats_across_segments_of_one_text(spark):
    """A passage that stands twice in a single document, once in each of two real segments, and nowhere else."""
    rng = random.Random(9)
    passage, parts = sentence(rng, 400), [sentence(rng, n) for n in (500, 250_000, 500)]
    text = f"{parts[0]}A{passage}B{parts[1]}C{passage}D{parts[2]}"
    assert len(parts[1]) > dedup.SEGMENT
    first = len(parts[0]) + 1
    second = first + len(passage) + 2 + len(parts[1])
    row, = dedup.find_repeats(docs(spark, [(1, text)])).collect()
    assert [(s["start"], s["end"]) for s in row.spans] == [(x, x + len(passage)) for x in (first, second)]


def test_segments_hold_the_phrases_of_the_whole_text(monkeypatch):
    raw = np.frombuffer((sentence(random.Random(4), 900) + "ab" * 700 + "a" * 700).encode(), np.uint8)
    whole = dedup.phrase_table(raw, 200, 120)
    for size in (242, 500, 3001):
        monkeypatch.setattr(dedup, "SEGMENT", size)
        assert all((x == y).all() for x, y in zip(dedup.phrase_table(raw, 200, 120), whole))


def test_awkward_rows(spark):
    rows = awkward()
    got = sorted((str(r.doc_id), r.n_bytes, bytes(r.kept)) for r in dedup.find_repeats(docs(spark, rows)).collect())
    want = sorted((str(i), n, kept) for (i, _), (n, _, kept) in zip(rows, brute([t for _, t in rows], 200)))
    assert got == want
    assert dedup.find_repeats(docs(spark, [])).count() == 0
    cut = dedup.remove_repeats(docs(spark, rows))
    assert cut.columns == docs(spark, []).columns and cut.count() == len(rows)


def test_query_digest(spark, tmp_path):
    docs(spark, [(1, "a" * 300), (2, "unlike")]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in op2_suffix_dedup(spark, str(tmp_path)).collect()}
    assert (rows[1].n_removed, rows[1].n_spans, rows[1].kept_sha256) == (300, 1, hashlib.sha256(b"").hexdigest())
    assert (rows[2].n_removed, rows[2].n_spans, rows[2].kept_sha256) == (0, 0, hashlib.sha256(b"unlike").hexdigest())
