import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from paperloom.llm import common
from paperloom.llm import decontamination as clean
from tests.llm.helpers import awkward, docs, sentence


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def brute(documents, benchmark):
    """(doc_id, item_id) -> similarity of the best window, whatever its fingerprint."""
    out = {}
    for item_id, item in benchmark:
        own = words(item)
        if not own:
            continue
        k = min(5, len(own))
        n = len(own) - k + 1
        wanted = collections.Counter(tuple(own[j:j + k]) for j in range(n))
        for doc_id, text in documents:
            w = words(text)
            shingles = [tuple(w[j:j + k]) for j in range(len(w) - k + 1)]
            size = min(n, len(shingles))
            best = 0
            for s in range(len(shingles) - size + 1 if size else 0):
                both = sum((collections.Counter(shingles[s:s + size]) & wanted).values())
                best = max(best, both / (n + size - both))
            if best >= 0.8 - 1e-12:
                out[doc_id, item_id] = best
    return out


def corpus(seed):
    rng = random.Random(seed)
    bench = [(k, sentence(rng, rng.choice([1, 3, 4, 5, 6, 30, 45, 80]))) for k in range(25)] + [(90, None), (91, ""), (92, "the the the the the the the the the the")]
    rows = []
    for k in range(120):
        text = sentence(rng, rng.randint(0, 150)).split()
        leak = rng.choice(bench[:25])[1].split()
        for _ in range(rng.choice([0, 0, 0, 1, 2, 3])):
            if leak:
                at = rng.randrange(len(leak))
                leak[at:at + rng.randint(0, 1)] = ["changed"] * rng.randint(0, 1)
        if rng.random() < 0.5:
            at = rng.randint(0, len(text))
            text[at:at] = leak
        rows.append((k, (", " if k % 7 == 0 else " ").join(text)))
    return rows + [(500, "The " * 40)], bench


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bound", [200_000, 0])
def test_against_all_windows(spark, monkeypatch, seed, bound):
    monkeypatch.setattr(common, "BROADCAST_ROWS", bound)  # 0: nothing is broadcast
    rows, bench = corpus(seed)
    got = {(r.doc_id, r.item_id): r for r in clean.contaminated(docs(spark, rows, clashing=True), items(spark, bench), 64).collect()}
    want = brute(rows, bench)
    assert {k: pytest.approx(r.similarity) for k, r in got.items()} == want and len(want) > 20
    if bound:
        near = {(r.doc_id, r.item_id): r for r in clean.contaminated(docs(spark, rows), items(spark, bench)).collect()}
        assert set(near) <= set(want) and {k for k, s in want.items() if s == 1} <= set(near)
        assert len(near) >= 0.97 * len(want) and all(r.distance <= clean.RADIUS for r in near.values())


def test_no_leak_is_lost_by_its_fingerprint(spark):
    """Items of nine words in documents that hold eight of them: 0.8 similar, some with fingerprints far apart."""
    rng = random.Random(21)
    bench = [(k, " ".join(f"w{rng.getrandbits(40)}" for _ in range(9))) for k in range(400)]
    rows = [(k, text.rsplit(" ", 1)[0]) for k, text in bench]
    got = clean.contaminated(docs(spark, rows), items(spark, bench)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(k, k) for k, _ in bench]
    assert all(r.similarity == pytest.approx(0.8) for r in got)
    assert any(r.distance > clean.RADIUS for r in got)
    assert clean.clean(docs(spark, rows), items(spark, bench)).count() == 0


def test_blocks_find_every_pair_within_the_radius(spark):
    rng = random.Random(3)
    pairs = []
    for k in range(400):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), rng.randint(0, 30)):
            y ^= 1 << bit
        pairs.append((k, x - (1 << 63), y - (1 << 63)))
    frame = spark.createDataFrame(pairs, "id long, x long, y long")
    a = frame.select("id", "x", clean.blocks(F.col("x"), 9).alias("p")).select("id", "x", "p.*")
    b = frame.select("id", "y", clean.blocks(F.col("y"), 9).alias("p")).select("id", "y", "p.*")
    met = {r.id for r in a.join(b, ["id", "block", "value"]).select("id").distinct().collect()}
    near = {k for k, x, y in pairs if bin((x ^ y) & (2**64 - 1)).count("1") <= 9}
    assert near and near <= met


def test_simhash_is_the_majority_of_bits(spark):
    rng = random.Random(8)
    rows = [(g, rng.getrandbits(64) - (1 << 63)) for g in range(5) for _ in range(rng.randint(1, 40))]
    got = {r.g: r.finger for r in clean.simhash(spark.createDataFrame(rows, "g int, h long"), ["g"]).collect()}
    for g in range(5):
        own = [h & (2**64 - 1) for k, h in rows if k == g]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own))
        assert got[g] & (2**64 - 1) == want


def test_awkward_rows(spark):
    rows, bench = awkward(), [(1, awkward()[6][1]), (None, "Two words"), (2, None), (3, ""), (1, awkward()[6][1])]
    found = clean.contaminated(docs(spark, rows), items(spark, bench)).select("doc_id", "item_id").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [(7, 1), (8, 1), (12, 1), (None, 1), (5, None)]))
    kept = clean.clean(docs(spark, rows), items(spark, bench))
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [1, 2, 3, 4, 6, 9, 10, 11, None]))
    assert clean.contaminated(docs(spark, rows), items(spark, [])).count() == 0
    assert clean.contaminated(docs(spark, []), items(spark, bench)).count() == 0
    assert clean.clean(docs(spark, rows), items(spark, [])).count() == len(rows)


def test_no_python_on_the_way(spark):
    rows, bench = corpus(1)
    plan = clean.contaminated(docs(spark, rows), items(spark, bench))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
