"""Dictionaries, bags of words, phrases and lemmas."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions.text import word_runs
from paperloom.operators import bow as B, lemmas as L, phrases as P
from paperloom.queries.registry import query
from paperloom.queries.texts import TOKENS_SQL, digest, token_table
from paperloom.session import staged, staged_by

COUNTS_SQL = f"""
  SELECT doc_id, token, count(*) AS cnt
  FROM (SELECT doc_id, unnest(tokens) AS token FROM ({TOKENS_SQL})) GROUP BY doc_id, token"""

VOCAB_SQL = f"""
  SELECT row_number() OVER (ORDER BY token) - 1 AS term_id, token AS term, count(*) AS doc_freq,
         CAST(sum(cnt) AS BIGINT) AS term_freq FROM ({COUNTS_SQL}) GROUP BY token"""


@query(COUNTS_SQL)
def doc_term_freq(t):
    return B.sorted_term_counts(token_table(t))


@query(f"SELECT token, count(*) AS cnt FROM (SELECT unnest(tokens) AS token FROM ({TOKENS_SQL})) GROUP BY token")
def corpus_counts(t):
    return B.corpus_counts(token_table(t))


@query(f"""
SELECT token, count(*) AS cnt FROM (SELECT unnest(tokens) AS token FROM ({TOKENS_SQL}))
GROUP BY token HAVING count(*) >= 5""")
def min_count_vocab(t):
    return B.frequent_terms(token_table(t), 5)


@query(f"SELECT count(DISTINCT token) AS terms FROM (SELECT unnest(tokens) AS token FROM ({TOKENS_SQL}))")
def vocab_size(t):
    return B.vocabulary_size(token_table(t))


@query(VOCAB_SQL)
def vocab(t):
    return B.vocabulary(B.term_counts(token_table(t)))


@query(f"""
WITH v AS ({VOCAB_SQL}), c AS ({COUNTS_SQL})
SELECT doc_id, term_id, cnt FROM c JOIN v ON c.token = v.term""")
def bow(t):
    counts = staged(B.term_counts(token_table(t)), "counts")
    return B.bag_of_words(counts, staged(B.vocabulary(counts), "vocabulary"))


@query(f"""
WITH v AS ({VOCAB_SQL}), c AS ({COUNTS_SQL})
SELECT doc_id, CAST(count(*) AS BIGINT) AS terms,
       md5(string_agg(term_id || ':' || cnt, ' ' ORDER BY term_id)) AS digest
FROM c JOIN v ON c.token = v.term GROUP BY doc_id""")
def bow_arrays(t):
    counts = staged(B.term_counts(token_table(t)), "counts")
    arrays = B.bow_arrays(B.bag_of_words(counts, staged(B.vocabulary(counts), "vocabulary")))
    text = F.array_join(F.transform("bow", lambda e: F.concat_ws(":", e.term_id, e.cnt)), " ")
    return arrays.select("doc_id", F.size("bow").cast("bigint").alias("terms"), F.md5(text).alias("digest"))


# Phrases.  The twin finds the merges with window functions: in each run of
# consecutive accepted positions every other one is a merge.
EACH_SQL = f"SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM ({TOKENS_SQL})"


def phrases_sql(each):
    """Common table expressions up to `merged` over rows (doc_id, pos, token)."""
    return f"""
WITH words AS (
  SELECT doc_id, pos, token, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS following FROM ({each})),
uni AS (SELECT token, count(*) AS cnt FROM words GROUP BY token),
pair AS (SELECT token AS l, following AS r, count(*) AS cnt FROM words
         WHERE following IS NOT NULL GROUP BY ALL),
size AS (SELECT (SELECT count(*) FROM uni) + (SELECT count(*) FROM pair) AS n),
phrase AS (
  SELECT l, r, pair.cnt AS cnt, CAST(pair.cnt - 5 AS DOUBLE) / a.cnt / b.cnt * size.n AS score
  FROM pair JOIN uni a ON a.token = l JOIN uni b ON b.token = r, size WHERE pair.cnt > 5),
accepted AS (SELECT * FROM phrase WHERE score > 10),
marked AS (
  SELECT w.*, a.score IS NOT NULL AS hit, a.score,
         sum(CASE WHEN a.score IS NULL THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY pos) AS run
  FROM words w LEFT JOIN accepted a ON w.token = a.l AND w.following = a.r),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, run, hit ORDER BY pos) % 2 = 1 AND hit AS merges
  FROM marked),
merged AS (
  SELECT *, coalesce(lag(merges) OVER (PARTITION BY doc_id ORDER BY pos), false) AS absorbed
  FROM numbered)"""


PHRASES_SQL = phrases_sql(EACH_SQL)
ONCE_SQL = f"""{PHRASES_SQL}
SELECT doc_id, pos, CASE WHEN merges THEN token || '_' || following ELSE token END AS token
FROM merged WHERE NOT absorbed"""


@query(f'{PHRASES_SQL}\nSELECT l AS "left", r AS "right", cnt, round(score, 6) AS score FROM accepted')
def phrase_scores(t):
    return P.phrase_scores(stored_tokens(t)).withColumn("score", F.round("score", 6))


def stored_tokens(t):
    """Tokens as a table stored by document: what is found in them comes to them, and they stay where they are."""
    return staged_by(token_table(t).select("doc_id", "tokens"), "doc_id", "tokens")


@query(f"""{PHRASES_SQL}
SELECT doc_id, count(*) AS words,
       md5(string_agg(CASE WHEN merges THEN token || '_' || following ELSE token END, chr(1)
                      ORDER BY pos)) AS digest
FROM merged WHERE NOT absorbed GROUP BY doc_id""")
def phrase_apply(t):
    table = stored_tokens(t)
    merged = P.apply_phrases(table, P.phrase_scores(table))
    return merged.filter(F.size("tokens") > 0).select("doc_id", *digest(F.col("tokens")))


@query(f"""{PHRASES_SQL}
SELECT token || '_' || following AS phrase, round(max(score), 6) AS score, count(*) AS occurrences
FROM merged WHERE merges AND NOT absorbed GROUP BY token, following""")
def phrase_report(t):
    table = stored_tokens(t)
    report = P.phrase_report(table, P.phrase_scores(table))
    return report.withColumn("score", F.round("score", 6))


@query(f"""{phrases_sql(ONCE_SQL)}
SELECT doc_id, count(*) AS words,
       md5(string_agg(CASE WHEN merges THEN token || '_' || following ELSE token END, chr(1)
                      ORDER BY pos)) AS digest
FROM merged WHERE NOT absorbed GROUP BY doc_id""")
def ngrams(t):
    """Two rounds."""
    merged, _ = P.detect_ngrams(stored_tokens(t))
    return merged.filter(F.size("tokens") > 0).select("doc_id", *digest(F.col("tokens")))


LEMMA_SQL = r"""
WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM documents),
forms AS (
  SELECT word, word AS lemma, 0 AS at_ FROM words
  UNION ALL SELECT word, left(word, length(word) - 1), 1 FROM words WHERE ends_with(word, 's')
  UNION ALL SELECT word, left(word, length(word) - 3) || 's', 2 FROM words WHERE ends_with(word, 'ses')
  UNION ALL SELECT word, left(word, length(word) - 3) || 'f', 3 FROM words WHERE ends_with(word, 'ves')
  UNION ALL SELECT word, left(word, length(word) - 3) || 'x', 4 FROM words WHERE ends_with(word, 'xes')
  UNION ALL SELECT word, left(word, length(word) - 3) || 'z', 5 FROM words WHERE ends_with(word, 'zes')
  UNION ALL SELECT word, left(word, length(word) - 4) || 'ch', 6 FROM words WHERE ends_with(word, 'ches')
  UNION ALL SELECT word, left(word, length(word) - 4) || 'sh', 7 FROM words WHERE ends_with(word, 'shes')
  UNION ALL SELECT word, left(word, length(word) - 3) || 'man', 8 FROM words WHERE ends_with(word, 'men')
  UNION ALL SELECT word, left(word, length(word) - 3) || 'y', 9 FROM words WHERE ends_with(word, 'ies')),
best AS (
  SELECT word, lemma FROM (
    SELECT word, lemma, row_number() OVER (PARTITION BY word ORDER BY length(lemma), at_) AS rn
    FROM forms WHERE lemma IN (SELECT word FROM words)) WHERE rn = 1 AND lemma <> word)"""


def _words(t):
    """Corpus words; the corpus's own vocabulary serves as the noun lexicon."""
    return t.documents.select(F.explode(word_runs("text")).alias("word")).distinct()


@query(f"{LEMMA_SQL}\nSELECT word, lemma FROM best")
def lemma_lookup(t):
    words = staged(_words(t), "words")
    return L.lemma_table(words, words)


@query(f"""{LEMMA_SQL}, each AS (
  SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM ({TOKENS_SQL}))
SELECT doc_id, count(*) AS words,
       md5(string_agg(coalesce(lemma, token), chr(1) ORDER BY pos)) AS digest
FROM each LEFT JOIN best ON token = word GROUP BY doc_id""")
def lemmatise(t):
    words = staged(_words(t), "words")
    lemmas = staged(L.lemma_table(words, words), "lemmas")
    replaced = L.lemmatise(stored_tokens(t), lemmas)
    return replaced.filter(F.size("tokens") > 0).select("doc_id", *digest(F.col("tokens")))
