import collections
import itertools
import random
import re

import numpy as np
import pytest

from paperloom.llm import jaccard_join as join
from paperloom.llm.common import components
from tests.llm.helpers import WORDS, awkward, docs, sentence


def word_sets(texts, size=5):
    out = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(size, len(words))
        out.append({tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if n else set())
    return out


def brute(rows, percent=80):
    sets = word_sets([t for _, t in rows])
    head = list(range(len(rows)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            head[find(a)] = find(b)
    least = collections.defaultdict(lambda: None)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            g = find(k)
            least[g] = i if least[g] is None else min(least[g], i)
    return sorted(((i, len(s), least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    shared = sentence(rng, 60)
    bases = [sentence(rng, rng.randint(6, 160)).split() for _ in range(12)]
    texts = []
    for _ in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 2)] = [rng.choice(WORDS)] * rng.randint(0, 2)
        text = " ".join(words)
        if rng.random() < 0.3:
            text = shared + "\n" + sentence(rng, rng.randint(1, 90))
        texts.append(text.upper() if rng.random() < 0.1 else text)
    return list(enumerate(texts))


def got(spark, rows, **more):
    frame = join.near_duplicate_components(docs(spark, rows, clashing=True), **more)
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    assert got(spark, rows) == brute(rows)


def test_longer_prefixes_lose_no_link():
    """Every document asks for several common shingles, differently many by its size."""
    plain = join.choose_prefix

    def longer(shingles, frequency, usual, percent):
        prefix, _ = plain(shingles, frequency * 0, usual, percent)
        share = 1 + len(shingles) // (5 if int(shingles[0]) % 2 else 10)
        return shingles[: join.base_prefix(len(shingles), percent) + share - 1], share

    rows = corpus(4)
    found = []
    texts = [t for _, t in rows]
    sets = [join.shingle_set(t) for t in texts]
    chosen = [longer(s, np.zeros(join.SKETCH), 0, 80) for s in sets]
    for a, b in itertools.combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            found.append(len(np.intersect1d(chosen[a][0], chosen[b][0])) >= min(chosen[a][1], chosen[b][1]))
    assert found and all(found)


def test_heavy_shingles_lengthen_prefixes():
    shingles = np.sort(join.mixed(np.arange(1, 201, dtype=np.uint64)))
    prefix, share = join.choose_prefix(shingles, np.zeros(join.SKETCH), 0.0, 80)
    assert (len(prefix), share) == (51, 11) and share == join.usual_share(200, 80)
    assert len(join.choose_prefix(shingles[:50], np.zeros(join.SKETCH), 0.0, 80)[0]) == join.base_prefix(50, 80)
    frequency = np.zeros(join.SKETCH)
    frequency[(shingles >> np.uint64(46)).astype(int)] = 1000
    prefix, share = join.choose_prefix(shingles, frequency, 1.0, 80)
    assert len(prefix) == 41 + share - 1 and share > 11


def test_awkward_rows(spark):
    rows = awkward()
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_crowd_of_near_copies(spark):
    rng = random.Random(9)
    base = sentence(rng, 120).split()
    rows = []
    for k in range(300):
        words = list(base)
        words[rng.randrange(120)] = f"w{k}"
        rows.append((k, " ".join(words)))
    assert {c for _, _, c in got(spark, rows)} == {0}


def test_components_of_chains(spark):
    rng = random.Random(3)
    chain = [(k, k + 1) for k in range(60)] + [(100, 200), (7, 7)]
    rng.shuffle(chain)
    out = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(out[k] == 0 for k in range(1, 61)) and out[200] == 100
