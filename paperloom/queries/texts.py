"""Tokenisers and normalisers over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.functions import text as T
from paperloom.functions.fields import has_preamble, is_reference_number
from paperloom.operators.bow import each_token
from paperloom.operators.topk import top_k_per_group
from paperloom.queries.registry import query

STOPWORDS = ("the", "of", "and", "in", "le", "la", "de", "et", "der", "die", "und", "el", "que")
_STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"
_PUNCT_SQL = "'" + C.ASCII_PUNCTUATION.replace("'", "''") + "'"
_RUNS = f"regexp_extract_all(lower(text), '{C.WORD_CHARS}+')"



def words_sql(expression: str) -> str:
    return f"[w FOR w IN string_split_regex({expression}, '{C.WHITESPACE}+') IF w <> '']"


TOKENS_SQL = f"""
  SELECT doc_id, lang, source,
         [CASE WHEN regexp_full_match(w, '\\p{{Nd}}+') THEN '<num>'
               WHEN w = 'latex_metatoken' THEN '<latex>' ELSE w END FOR w IN {_RUNS}] AS tokens
  FROM documents"""


def token_table(t):
    """documents -> (doc_id, lang, source, tokens)."""
    return t.documents.select("doc_id", "lang", "source", T.cleanse("text").alias("tokens"))


def digest(words):
    """Count and digest of a word array, so a check covers every word in order."""
    return [
        F.size(words).cast("bigint").alias("words"),
        F.md5(F.array_join(words, "\x01")).alias("digest"),
    ]


def digest_sql(expression: str) -> str:
    return (
        f"SELECT doc_id, CAST(len(words) AS BIGINT) AS words, md5(array_to_string(words, chr(1))) AS digest "
        f"FROM (SELECT doc_id, {expression} AS words FROM documents)"
    )


@query(f"""
SELECT lang, token, cnt, CAST(rank AS INTEGER) AS rank FROM (
  SELECT lang, token, count(*) AS cnt,
         row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, token) AS rank
  FROM (SELECT lang, unnest(tokens) AS token FROM ({TOKENS_SQL})) GROUP BY lang, token)
WHERE rank <= 10""")
def top_terms(t):
    each = each_token(token_table(t), "lang")
    counts = each.groupBy("lang", "token").agg(F.count("*").alias("cnt"))
    return top_k_per_group(counts, ["lang"], [F.desc("cnt"), F.asc("token")], 10)


@query(f"""
SELECT doc_id, CAST(len(tokens) AS BIGINT) AS words, md5(array_to_string(tokens, chr(1))) AS digest
FROM ({TOKENS_SQL})""")
def tokens(t):
    return token_table(t).select("doc_id", *digest(F.col("tokens")))


@query(f"""
SELECT lang, count(*) FILTER (WHERE token = '<num>') AS numbers,
       count(*) FILTER (WHERE token = '<latex>') AS formulas, count(*) AS tokens
FROM (SELECT lang, unnest(tokens) AS token FROM ({TOKENS_SQL})) GROUP BY lang""")
def num_metatoken(t):
    each = each_token(token_table(t), "lang")
    return each.groupBy("lang").agg(
        F.count_if(F.col("token") == C.NUMBER_TOKEN).alias("numbers"),
        F.count_if(F.col("token") == C.MATH_TOKEN).alias("formulas"),
        F.count("*").alias("tokens"),
    )


@query(f"SELECT doc_id, md5(translate(text, {_PUNCT_SQL}, '')) AS digest FROM documents")
def punct_strip(t):
    return t.documents.select("doc_id", F.md5(T.strip_punctuation("text")).alias("digest"))


@query("""
SELECT doc_id, md5(replace(text, chr(10), '')) AS glued, md5(replace(text, chr(10), ' ')) AS spaced
FROM documents""")
def newline_strip(t):
    return t.documents.select(
        "doc_id", F.md5(T.strip_newlines("text", "")).alias("glued"),
        F.md5(T.strip_newlines("text")).alias("spaced"),
    )


@query(digest_sql(
    f"[w FOR w IN {words_sql('lower(text)')} IF w NOT IN {_STOP_SQL}]"))
def stop_filter(t):
    words = T.drop_stopwords(T.whitespace_words(F.lower("text")), STOPWORDS)
    return t.documents.select("doc_id", *digest(words))


@query(digest_sql(words_sql(
    f"translate(array_to_string([w FOR w IN {words_sql('lower(text)')} IF w NOT IN {_STOP_SQL}], ' '), "
    f"{_PUNCT_SQL}, '')")))
def stop_free_words(t):
    return t.documents.select("doc_id", *digest(T.stop_free_words("text", STOPWORDS)))


@query(f"""
SELECT doc_id, md5(array_to_string([w FOR w IN {words_sql("lower(replace(text, chr(10), ' '))")}
                                    IF w NOT IN {_STOP_SQL}], ' ')) AS digest FROM documents""")
def clean_abstract(t):
    return t.documents.select("doc_id", F.md5(T.clean_abstract("text", STOPWORDS)).alias("digest"))


@query(digest_sql(
    f"[w FOR w IN regexp_extract_all(lower(text), '{C.ALPHABETIC_CHARS}+') "
    "IF length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_')]"))
def simple_preprocess(t):
    return t.documents.select("doc_id", *digest(T.simple_preprocess("text")))


@query(digest_sql("string_split(text, ' ')"))
def blank_words(t):
    return t.documents.select("doc_id", *digest(T.blank_words("text")))


@query(digest_sql(words_sql("text")))
def whitespace_words(t):
    return t.documents.select("doc_id", *digest(T.whitespace_words("text")))


@query(digest_sql(words_sql(f"lower(translate(text, {_PUNCT_SQL}, ''))")))
def punctuation_free_words(t):
    return t.documents.select("doc_id", *digest(T.punctuation_free_words("text")))


@query("""
SELECT doc_id, regexp_matches(text, '\\\\document(class|style)') AS preamble FROM documents""")
def preamble_test(t):
    return t.documents.select("doc_id", has_preamble("text").alias("preamble"))


@query("""
SELECT page_id, unnest(string_split(url, '/')) AS piece,
       regexp_matches(trim(unnest(string_split(url, '/'))), '^[(]?\\p{Nd}*[)]?$') AS number_like FROM pages""")
def reference_numbers(t):
    """Pieces of page addresses stand in for citation labels."""
    pieces = t.pages.select("page_id", F.explode(F.split("url", "/")).alias("piece"))
    return pieces.withColumn("number_like", is_reference_number("piece"))
