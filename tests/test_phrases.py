import random
from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from paperloom.operators import phrases as P

SCHEMA = "doc_id int, tokens array<string>"


def scores(docs, min_count, threshold):
    words = Counter(w for d in docs for w in d)
    pairs = Counter(p for d in docs for p in zip(d, d[1:]))
    size = len(words) + len(pairs)
    found = {}
    for (a, b), n in pairs.items():
        score = (n - min_count) / words[a] / words[b] * size
        if score > threshold:
            found[a, b] = score
    return found


def merge(doc, accepted):
    out, i = [], 0
    while i < len(doc):
        if i + 1 < len(doc) and (doc[i], doc[i + 1]) in accepted:
            out.append(doc[i] + "_" + doc[i + 1])
            i += 2
        else:
            out.append(doc[i])
            i += 1
    return out


def frame(spark, docs):
    return spark.createDataFrame(list(enumerate(docs)), SCHEMA)


def corpus(seed):
    random.seed(seed)
    phrases = [["new", "york"], ["radio", "source", "list"], ["very", "large", "radio", "source"]]
    docs = []
    for _ in range(60):
        doc = []
        for _ in range(random.randrange(0, 12)):
            doc += random.choice(phrases) if random.random() < 0.3 else [f"w{random.randrange(40)}"]
        docs.append(doc)
    return docs


def test_golden_merge(spark):
    pairs = spark.createDataFrame([("a", "b")], "left string, right string")
    got = {r.doc_id: r.tokens for r in P.apply_phrases(
        frame(spark, [["a", "b", "c", "a", "b"], ["a"], [], ["a", "a", "b"]]), pairs).collect()}
    assert got == {0: ["a_b", "c", "a_b"], 1: ["a"], 2: [], 3: ["a", "a_b"]}


def test_two_rounds_equal_a_loop(spark):
    docs = corpus(1)
    tokens = frame(spark, docs)
    got, tables = P.detect_ngrams(tokens, min_count=2, threshold=1.0)
    for table in tables:
        want = scores(docs, 2, 1.0)
        have = {(r.left, r.right): r.score for r in table.collect()}
        assert have.keys() == want.keys()
        assert all(abs(have[k] - want[k]) < 1e-9 for k in want)
        docs = [merge(d, want) for d in docs]
    assert [r.tokens for r in sorted(got.collect(), key=lambda r: r.doc_id)] == docs
    assert any("_" in w and w.count("_") >= 2 for d in docs for w in d)


def test_report_counts_merges(spark):
    docs = corpus(2)
    tokens = frame(spark, docs)
    table = P.phrase_scores(tokens, min_count=2, threshold=1.0)
    accepted = scores(docs, 2, 1.0)
    want = Counter()
    for doc in docs:
        i = 0
        while i + 1 < len(doc):
            if (doc[i], doc[i + 1]) in accepted:
                want[doc[i] + "_" + doc[i + 1]] += 1
                i += 2
            else:
                i += 1
    got = {r.phrase: r.occurrences for r in P.phrase_report(tokens, table).collect()}
    assert got == dict(want)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), min_size=1, max_size=40),
       st.sets(st.tuples(st.sampled_from("abc"), st.sampled_from("abc")), min_size=1))
def test_merging_follows_the_greedy_rule(spark, docs, accepted):
    pairs = spark.createDataFrame(sorted(accepted), "left string, right string")
    got = P.apply_phrases(frame(spark, docs), pairs).collect()
    assert [r.tokens for r in sorted(got, key=lambda r: r.doc_id)] == [merge(d, accepted) for d in docs]
