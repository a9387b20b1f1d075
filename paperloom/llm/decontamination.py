"""Benchmark decontamination with DataFrame functions alone.

A document is contaminated by a benchmark item if one of its windows of the item's length in words is similar to
it: weighted Jaccard similarity (each shingle counted as often as it occurs) of word shingles of at least
`PERCENT` / 100.

1.  Shingles of a text meet those of the items.  A similar window shares at least ceil(t (n + n') / (1 + t))
    of its positions with the item, so pairs with fewer common positions are dropped, then windows with fewer.
2.  The similarity is exact, from the common shingles: a window that reaches `PERCENT` is a leak.
3.  Leaks get a SimHash (per bit, the shingles that have it set are summed, and the majority wins), whose distance from
    the item's is reported.  It decides nothing, as similar windows can differ in more bits than any useful radius.
    A caller who gives a `radius` gets only leaks within it: fingerprints are cut into radius + 1 blocks, two within the
    radius agree in one block at least, and the distance is counted on those that an equi join on blocks finds.

Words are lower-cased runs of letters, digits and all that is not ASCII.  An item or window with fewer words than a
shingle is one shingle; a text shorter than an item is one window.  Null or empty texts and items match
nothing.  Equal texts are looked at once; a repeated document row is reported once, a null doc_id as null.  Rows
of equal item_id and text are one item; a null item_id is reported as null.  Other columns are not read.
What is sent to all executors (items, windows to look at) is counted first and joined by a shuffle beyond a bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import WORD_PATTERN, bounded, staged

WORDS, PERCENT = 5, 80
# Distance that leaks seldom exceed; not applied unless a caller asks for it.
RADIUS = 19


def shingles_of(text, k: int):
    """Hash of the k words from each word on, null where fewer follow: one entry per word."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD_PATTERN), F.lit(0))

    def hashes(ws):
        return F.transform(ws, lambda w, i: F.when(i <= F.size(ws) - k, F.xxhash64(w, *(F.get(ws, i + j) for j in range(1, k)))))

    return F.get(F.transform(F.array(words), hashes), 0)  # the inner array is bound once


def _positions(table: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(keys, n_words, pos, h) for each shingle."""
    hashed = table.select(*keys, shingles_of(F.col("text"), k).alias("hs"))
    return (hashed.select(*keys, F.size("hs").alias("n_words"), F.posexplode_outer("hs").alias("pos", "h")).where("h is not null"))


def _need(n, other):
    """Common positions that similarity asks for."""
    return F.ceil((n + other) * PERCENT / F.lit(100.0 + PERCENT) - F.lit(1e-9))


def _bit_sums(h):
    """Each bit of a hash in a field of 32 bits, two to a long, so that sums of longs count bits."""
    return [(F.shiftright(h, b).bitwiseAND(F.lit(1)) + F.shiftleft(F.shiftright(h, b + 1).bitwiseAND(F.lit(1)), 32)) for b in range(0, 64, 2)]


def simhash(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, finger): majority of each bit over the rows (keys, h)."""
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(_bit_sums(F.col("h")))]
    counted = shingles.groupBy(*keys).agg(F.count("*").alias("n"), *sums)
    finger = F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright(F.col(f"s{i}"), 32)
        for bit, count in ((2 * i, low), (2 * i + 1, high)):
            mask = 1 << bit if bit < 63 else -(1 << 63)
            finger = finger.bitwiseOR(F.when(count * 2 > F.col("n"), F.lit(mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, finger.alias("finger"))


def blocks(finger, radius: int):
    """(block, value) of each of radius + 1 blocks of a fingerprint."""
    edges = [64 * b // (radius + 1) for b in range(radius + 2)]
    return F.explode(F.array(*(
        F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(finger, low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("value"))
        for b, (low, high) in enumerate(zip(edges, edges[1:])))))


def contaminated(docs: DataFrame, items: DataFrame, radius: int | None = None) -> DataFrame:
    """(doc_id, mark, item_id, window_start, similarity, distance): the best window of each contaminated document and item.

    `docs` has doc_id and text, `items` item_id and text; `mark` is the hash of the document's text, for joining back.
    """
    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    texts = docs.select("doc_id", "text", mark.alias("mark"))
    items = items.select("item_id", "text").distinct().withColumn("item", F.xxhash64("item_id", "text"))
    words = F.size(shingles_of(F.col("text"), 1))
    items = staged(items.withColumn("words", words).where("words > 0"), "items")
    found = []
    for k in sorted(row.k for row in items.select(F.least("words", F.lit(WORDS)).alias("k")).distinct().collect()):  # at most WORDS values
        found.append(_of_shingle_size(texts, items.where(F.least("words", F.lit(WORDS)) == k), k, radius))
    if not found:
        return (texts.select("doc_id", "mark").join(items.select("item", "item_id"), F.lit(False))
                .select("doc_id", "mark", "item_id", F.lit(0).alias("window_start"), F.lit(0.0).alias("similarity"), F.lit(0).alias("distance")))
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    named = together.join(bounded(items.select("item", "item_id")), "item")
    owners = texts.select("doc_id", "mark").join(bounded(staged(named.select("mark").distinct(), "marks")), "mark", "left_semi").distinct()
    return owners.join(named, "mark").select("doc_id", "mark", "item_id", "window_start", "similarity", "distance")


def _of_shingle_size(texts: DataFrame, items: DataFrame, k: int, radius: int | None) -> DataFrame:
    """(mark, item, window_start, similarity, distance) for the items that have shingles of k words."""
    parts = staged(_positions(items, ["item", "words"], k).select("item", "words", "pos", "h"), "shingles")
    known = parts.groupBy("item", "words", "h").agg(F.count("*").cast("int").alias("times"))
    hits = (_positions(texts, ["mark"], k).join(bounded(known.select("h").distinct()), "h", "left_semi").distinct())
    hits = staged(hits, "hits").join(bounded(known), "h")
    n = (F.col("words") - (k - 1))
    own = F.least(n, F.col("n_words") - (k - 1))  # shingles of a window
    rows = hits.withColumn("n", n).withColumn("own", own)
    enough = (rows.groupBy("mark", "item", "n", "own").agg(F.count("*").alias("c")).where(F.col("c") >= _need(F.col("n"), F.col("own")))
              .select("mark", "item"))
    starts = F.sequence(F.greatest(F.lit(0), F.col("pos") - F.col("own") + 1), F.least(F.col("pos"), F.col("n_words") - (k - 1) - F.col("own")))
    windows = (rows.join(enough, ["mark", "item"], "left_semi").withColumn("start", F.explode(starts))
               .groupBy("mark", "item", "n", "own", "start", "h").agg(F.count("*").alias("c"), F.max("times").alias("times"))
               .groupBy("mark", "item", "n", "own", "start").agg(F.sum(F.least("c", "times")).alias("both"))
               .withColumn("similarity", F.col("both") / (F.col("n") + F.col("own") - F.col("both")))
               .where(F.col("both") * 100 >= (F.col("n") + F.col("own") - F.col("both")) * PERCENT))
    windows = staged(windows, "windows")
    # Copies of a text give equal fingerprints; distinct drops them.
    near = (_positions(texts.select("mark", "text").join(bounded(windows.select("mark").distinct()), "mark", "left_semi"), ["mark"], k)
            .select("mark", "pos", "h").distinct())
    inside = (near.join(bounded(windows.select("mark", "item", "start", "own")), "mark")
              .where((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + F.col("own"))))
    fingers = simhash(inside, ["mark", "item", "start"])
    wanted = simhash(parts.select("item", "h"), ["item"])
    distance = F.bit_count(F.col("finger").bitwiseXOR(F.col("other"))).alias("distance")
    if radius is None:
        met = fingers.join(bounded(wanted.select("item", F.col("finger").alias("other"))), "item").select("mark", "item", "start", distance)
    else:
        met = (fingers.select("*", blocks(F.col("finger"), radius).alias("part")).select("mark", "item", "start", "finger", "part.*")
               .join(bounded(wanted.select("item", F.col("finger").alias("other"), blocks(F.col("finger"), radius).alias("part"))
                              .select("item", "other", "part.*")), ["item", "block", "value"])
               .select("mark", "item", "start", distance).distinct().where(F.col("distance") <= radius))
    best = (met.join(windows, ["mark", "item", "start"]).groupBy("mark", "item")
            .agg(F.max(F.struct("similarity", (-F.col("distance")).alias("d"), (-F.col("start")).alias("s"))).alias("top")))
    return best.select("mark", "item", (-F.col("top.s")).alias("window_start"), F.col("top.similarity").alias("similarity"),
                       (-F.col("top.d")).alias("distance"))


def clean(docs: DataFrame, items: DataFrame, radius: int | None = None) -> DataFrame:
    """`docs` without the contaminated ones, all columns kept."""
    bad = bounded(staged(contaminated(docs, items, radius).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct(), "contaminated"))
    mark = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("_id")) & (mark == F.col("_mark")), "left_anti")
