"""Small tables with the awkward rows every operator has to take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b + c for a in ("th", "on", "er", "ve", "li") for b in ("an", "or", "es") for c in ("d", "ing", "ly", "s", "t")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def docs(spark, rows, clashing=False):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
    made = spark.createDataFrame(full, DOCS)
    if clashing:
        for name in ("n_bytes", "spans", "kept", "own", "mark", "cid", "token", "score", "labels", "start", "rejected", "item_id", "host", "key", "blocked"):
            made = made.withColumn(name, made["source"])
    return made


def awkward(seed=1):
    rng = random.Random(seed)
    long = sentence(rng, 60_000)
    same = sentence(rng, 120)
    return [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "Two words"), (6, long), (7, same), (8, same), (8, same),
            (None, same), (None, None), (9, "é ü ß 漢字 \U0001F600 " * 40), (10, "a" * 5000), (11, "ab " * 2000), (12, same[:-3] + "xyz")]
