"""Trained models over whole tables.

What training gives is no SQL result, so each query returns what must hold of it, row by row, for its twin to state.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Window, functions as F

from paperloom.models import embeddings as E, layout as Y, topics, word_means as M
from paperloom.operators import bow as B, similarity as S
from paperloom.plans.analyse import phrase_words
from paperloom.queries.registry import query
from paperloom.queries.terms import stored_tokens
from paperloom.queries.texts import TOKENS_SQL
from paperloom.queries.vectors import vectors
from paperloom.session import scratch_path, staged

# Side-by-side workers of a training, so that a result does not depend on the cluster.
WORKERS = 8


@query("""
SELECT topic, "rank", true AS known, true AS weighted FROM (VALUES (0), (1), (2)) a(topic), (VALUES (1), (2), (3)) b("rank")""")
def lda_topics(t):
    """Three topics, fifty passes over all documents: terms are corpus words, weights fall and lie within 0 and 1."""
    tokens = stored_tokens(t)
    terms = topics.corpus_topics(tokens, 3, 50, 3, seed=1)
    words = B.corpus_counts(tokens).select(F.col("token").alias("term"), F.lit(True).alias("known"))
    following = F.max("weight").over(Window.partitionBy("topic").orderBy("rank").rowsBetween(1, 1))
    checked = terms.withColumn("next", following).join(words, "term", "left")
    return checked.select(
        "topic", "rank", F.coalesce("known", F.lit(False)).alias("known"),
        ((F.col("weight") > 0) & (F.col("weight") <= 1) & F.coalesce(F.col("next") <= F.col("weight"), F.lit(True))).alias("weighted"))


def _of_three_subjects(tokens):
    """Each document's words as words of one of three subjects, told by their lengths: six to a subject."""
    subject = F.pmod(F.col("doc_id"), F.lit(3)).cast("string")
    return tokens.withColumn("tokens", F.transform("tokens", lambda w: F.concat(
        F.lit("w"), (F.length(w) % 6).cast("string"), F.lit("_"), subject)))


@query(f"""
SELECT DISTINCT ((doc_id % 3) + 3) % 3 AS subject, 'w' || length(token) % 6 || '_' || ((doc_id % 3) + 3) % 3 AS term
FROM (SELECT doc_id, unnest(tokens) AS token FROM ({TOKENS_SQL}))""")
def planted_topics(t):
    """Of a corpus of three subjects with words of their own, the topics are the subjects: each one's six strongest terms."""
    terms = topics.corpus_topics(_of_three_subjects(stored_tokens(t)), 3, 50, 6, seed=2)
    strongest = F.min_by("term", "rank").over(Window.partitionBy("topic"))
    return terms.select(F.substring_index(strongest, "_", -1).cast("long").alias("subject"), "term")


@query(f"SELECT count(DISTINCT token) AS terms, 5 AS topics FROM (SELECT unnest(tokens) AS token FROM ({TOKENS_SQL}))")
def stored_topics(t):
    """A topic model written and read back has its vocabulary and its topics."""
    model, _ = topics.train_corpus_topics(stored_tokens(t), 5, 10, seed=1)
    path = scratch_path(t.spark, "topics")
    topics.save_model(model, path)
    back = topics.load_topics(path, spread=True)
    return t.spark.range(1).select(F.lit(back.vocabSize()).cast("long").alias("terms"), F.lit(back.describeTopics(1).count()).cast("int").alias("topics"))


@query("""SELECT "rank", true AS known, true AS other, true AS ordered FROM range(1, 11) r("rank")""")
def word_neighbours(t):
    """300 wide, ten iterations: ten other frequent words, most similar first."""
    tokens = stored_tokens(t)
    model = E.train_words(tokens, width=300, window=5, min_count=5, iterations=10, partitions=WORKERS, seed=1)
    word = model.getVectors().agg(F.min("word")).first()[0]
    near = E.neighbours(model, word, 10)
    order = Window.orderBy(F.desc("similarity"), "word")  # ten rows
    ranked = near.withColumn("rank", F.row_number().over(order)).withColumn("above", F.lag("similarity").over(order))
    frequent = B.frequent_terms(tokens, 5).select(F.col("token").alias("word"), F.lit(True).alias("known"))
    return ranked.join(frequent, "word", "left").select(
        F.col("rank").cast("long").alias("rank"), F.coalesce("known", F.lit(False)).alias("known"), (F.col("word") != word).alias("other"),
        (F.coalesce(F.col("above") >= F.col("similarity"), F.lit(True)) & F.col("similarity").between(-1.0001, 1.0001)).alias("ordered"))


@query(f"""
SELECT DISTINCT ((doc_id % 3) + 3) % 3 AS subject, 'w' || length(token) % 6 || '_' || ((doc_id % 3) + 3) % 3 AS word, CAST(5 AS BIGINT) AS near
FROM (SELECT doc_id, unnest(tokens) AS token FROM ({TOKENS_SQL}))""")
def planted_neighbours(t):
    """Of a corpus of three subjects with six words each, a word's five nearest are the other words of its subject."""
    tokens = _of_three_subjects(stored_tokens(t))
    words = staged(E.word_table(E.train_words(tokens, width=100, window=5, min_count=1, iterations=5, partitions=WORKERS, seed=1)), "words")
    found = S.nearest_all(words, 5, key="word")
    subject = lambda c: F.substring_index(c, "_", -1)
    return found.groupBy("word").agg(F.count_if(subject("word") == subject("neighbour")).alias("near")).select(
        subject("word").cast("long").alias("subject"), "word", "near")


@query(f"""
SELECT token AS word, CAST(50 AS BIGINT) AS width FROM (SELECT unnest(tokens) AS token FROM ({TOKENS_SQL}))
GROUP BY token HAVING count(*) >= 5""")
def stored_words(t):
    """A word model is trained and stored; asked for again, with other settings, it is the stored one that comes."""
    tokens = stored_tokens(t)
    path = scratch_path(t.spark, "words")
    E.words_or_train(tokens, path, width=50, window=5, min_count=5, iterations=2, partitions=WORKERS, seed=1)
    again = E.words_or_train(tokens, path, width=10, min_count=10**9)
    return E.word_table(again).select("word", F.size("vector").cast("long").alias("width"))


def _cell_by_cell(table, names, place, lengths):
    """Sums of each component over all occurrences of a block's words, and their numbers."""
    known = np.append(table.table.places(names), -1)[place]
    at = np.flatnonzero(known >= 0)
    row, word = np.repeat(np.arange(len(lengths)), lengths)[at], known[at]
    cells = [np.bincount(row, column[word], len(lengths)) for column in np.ascontiguousarray(table.vectors.T)]
    return np.stack(cells, axis=1), np.bincount(row, minlength=len(lengths))


@query("SELECT doc_id, CAST(100 AS BIGINT) AS width, true AS agrees FROM documents")
def doc_vectors(t):
    """100 wide, four iterations: a document's vector is the mean of its words', here taken cell by cell."""
    tokens = stored_tokens(t)
    model = E.train_words(tokens, width=100, window=5, min_count=1, iterations=4, partitions=WORKERS, seed=1)
    words = E.word_table(model)
    sums = M.document_sums(tokens, M.spread_table(words.select("word", "vector", F.lit(1.0).alias("weight"))), _cell_by_cell, "doc_id").filter("n > 0")
    total = sums.groupBy("doc_id").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"), F.sum("n").alias("n"))
    means = total.select("doc_id", F.transform(vector_to_array("sums"), lambda s: s / F.col("n")).alias("mean"))
    both = E.infer_vectors(model, tokens).join(means, "doc_id", "left")
    gap = F.aggregate(F.zip_with("vector", "mean", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, v: F.greatest(s, v))
    return both.select("doc_id", F.coalesce(F.size("vector").cast("long"), F.lit(100)).alias("width"), F.coalesce(gap < 1e-4, F.col("mean").isNull()).alias("agrees"))


@query("SELECT true AS complete, true AS finite, true AS laid_out")
def phrase_word_vectors(t):
    """At the defaults of `phrase_words`: word vectors of a corpus with merged phrases, and the layout of that vocabulary."""
    tokens = stored_tokens(t)
    words = staged(E.word_table(phrase_words(tokens, partitions=WORKERS, seed=1)), "words")
    xy = staged(Y.layout(words, key="word"), "layout")
    n, merged = words.count(), words.filter(F.contains("word", F.lit("_"))).count()
    good = words.filter((F.size("vector") == 100) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x))).count()
    placed = xy.filter(~F.isnan("x") & ~F.isnan("y")).count()
    return t.spark.range(1).select(
        F.lit(n > 0 and merged > 0).alias("complete"), F.lit(good == n).alias("finite"), F.lit(placed == n).alias("laid_out"))


@query("""
SELECT count(*) AS points, CAST(0.0 AS DOUBLE) AS covariance, true AS ordered, true AS within
FROM embeddings""")
def layout_pca(t):
    """Coordinates on principal axes are uncorrelated, the first varies most, both no more than the vectors do."""
    table = vectors(t)
    xy = Y.layout(table)
    moments = xy.agg(F.count("*").alias("points"), F.covar_pop("x", "y").alias("c"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"))
    spread = (table.select(F.posexplode("vector").alias("pos", "v")).groupBy("pos").agg(F.var_pop("v").alias("v"))
              .agg(F.sum("v").alias("total"))).scalar()
    return moments.select("points", (F.round("c", 6) + F.lit(0.0)).alias("covariance"), (F.col("vx") >= F.col("vy")).alias("ordered"),
                          (F.col("vx") + F.col("vy") <= spread * 1.000001).alias("within"))


_E = "CAST(e.embedding AS DOUBLE[])"
_Q = "CAST(q.embedding AS DOUBLE[])"
_COS = (f"list_sum([a[1] * a[2] FOR a IN list_zip({_E}, {_Q})]) / "
        f"(sqrt(list_sum([x * x FOR x IN {_E}])) * sqrt(list_sum([x * x FOR x IN {_Q}])))")


@query(f"""
SELECT doc_id, similarity, true AS placed FROM (
  SELECT e.vec_id AS doc_id, round({_COS}, 6) AS similarity
  FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 7) q
  WHERE e.vec_id <> 7 ORDER BY {_COS} DESC, e.vec_id LIMIT 10)
UNION ALL SELECT 7, 1.0, true""")
def neighbourhood(t):
    table = vectors(t)
    near = S.neighbourhood(table, 7, Y.layout(table), 10, key="doc_id")
    return near.select("doc_id", F.round("similarity", 6).alias("similarity"), (~F.isnan("x") & ~F.isnan("y")).alias("placed"))
