"""Markup extraction and citation counting."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions.markup import MarkupRules, abstract_text, markup_text
from paperloom.functions.text import cleanse
from paperloom.operators import markup as M
from paperloom.queries.registry import Tables, query
from paperloom.queries.texts import digest

# Pages: `article` plays the section, `p` the paragraph, `b` the formula.
PAGE_RULES = MarkupRules(
    keep=("article",), fallback=("p",), drop=("script", "style", "nav", "footer", "h1"),
    replace={"b": " latex_metatoken "}, html=True,
)


def escaped(column):
    text = F.replace(F.col(column), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def papers(t: Tables):
    """Documents written as marked-up papers.

    Each has a dropped title, a formula, and one citation whose kind follows from
    the document number: 0 parenthetical, 1 in text with a named label, 2 in text
    with a numeric label, 3 in text with an unknown key, 4 without a class.
    """
    kind = F.col("doc_id") % 5
    css = F.when(kind == 0, ' class="ltx_citemacro_citep"').when(
        kind == 4, ""
    ).otherwise(' class="ltx_citemacro_citet"')
    key = F.when(kind == 3, "missing").otherwise("k")
    label = F.when(kind == 2, "(12)").otherwise(F.concat(F.lit("Doe "), F.col("doc_id").cast("string")))
    xml = F.concat(
        F.lit('<?xml version="1.0"?><document xmlns="http://example.org/ns"><abstract><p>About <Math>x</Math>'),
        F.col("source"), F.lit("</p></abstract><section><title>Head</title><para><p>"), escaped("text"),
        F.lit(" <Math><XMTok>y</XMTok></Math>end <cite"), css, F.lit('>ref<bibref bibrefs="'), key,
        F.lit('"/></cite>.<note>foot</note></p></para></section><bibliography><bibitem key="k"><tags>'
              '<tag role="refnum">'), label, F.lit("</tag></tags></bibitem></bibliography></document>"),
    )
    return t.documents.select("doc_id", xml.alias("xml"))


PAPER_TEXT_SQL = """
  SELECT doc_id, text || '  latex_metatoken end ' || CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'Doe ' || doc_id
    WHEN 2 THEN 'ref' WHEN 3 THEN '' ELSE 'ref' END || '.' AS body FROM documents"""


@query(f"SELECT doc_id, md5(body) AS digest FROM ({PAPER_TEXT_SQL})")
def paper_text(t):
    return papers(t).select("doc_id", F.md5(markup_text(F.col("xml"))).alias("digest"))


@query(f"""
SELECT doc_id, CAST(len(words) AS BIGINT) AS words, md5(array_to_string(words, chr(1))) AS digest FROM (
  SELECT doc_id, [CASE WHEN regexp_full_match(w, '\\p{{Nd}}+') THEN '<num>'
                       WHEN w = 'latex_metatoken' THEN '<latex>' ELSE w END
                  FOR w IN regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]+')] AS words
  FROM ({PAPER_TEXT_SQL}))""")
def paper_tokens(t):
    parsed = M.parse_documents(papers(t))
    return M.token_documents(parsed).select("doc_id", *digest(F.col("tokens")))


@query("""
SELECT doc_id, CAST(CASE WHEN doc_id % 5 IN (0, 2, 3) THEN 1 ELSE 0 END AS BIGINT) AS parenthetical,
       CAST(CASE WHEN doc_id % 5 = 1 THEN 1 ELSE 0 END AS BIGINT) AS in_text
FROM documents WHERE doc_id % 5 <> 4""")
def citation_counts(t):
    return M.citation_counts(M.parse_documents(papers(t)))


@query("""
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'ltx_citemacro_citep' ELSE 'ltx_citemacro_citet' END AS cite_class,
       CASE doc_id % 5 WHEN 3 THEN 'missing' ELSE 'k' END AS cite_key,
       CASE doc_id % 5 WHEN 3 THEN NULL WHEN 2 THEN '(12)' ELSE 'Doe ' || doc_id END AS label,
       doc_id % 5 <> 3 AS found FROM documents WHERE doc_id % 5 <> 4""")
def resolved_citations(t):
    parsed = M.parse_documents(papers(t))
    return M.resolved_citations(parsed).select("doc_id", "cite_class", "cite_key", "label", "found")


@query("SELECT doc_id, 'About ' || source AS abstract FROM documents")
def paper_abstract(t):
    return papers(t).select("doc_id", abstract_text(F.col("xml")).alias("abstract"))


@query(r"""
WITH part AS (
  SELECT page_id, regexp_replace(regexp_extract(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                                 '(?s)<article>(.*?)(</article>|$)', 1), '(?s)<h1>.*?</h1>', '', 'g') AS body FROM pages),
bold AS (
  SELECT page_id, regexp_replace(regexp_replace(body, '(?s)<b>.*?(</b>|(<p>)|(</p>)|$)', ' latex_metatoken \2\3', 'g'),
                                 '<[^>]*(>|$)', '', 'g') AS body FROM part),
plain AS (SELECT page_id, replace(replace(replace(replace(body, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS body FROM bold)
SELECT page_id, CAST(length(body) AS INTEGER) AS chars, md5(body) AS digest, CAST(NULL AS VARCHAR) AS error FROM plain""")
def page_text(t):
    """Pages are tag soup, of a kind that regular expressions can still take apart."""
    pages = t.pages.select(F.col("page_id").alias("doc_id"), F.col("html").alias("xml"))
    parsed = M.parse_documents(pages, PAGE_RULES)
    return parsed.select(
        F.col("doc_id").alias("page_id"), F.length("text").alias("chars"), F.md5("text").alias("digest"), "error"
    )


@query(r"""
SELECT page_id, CAST(len(regexp_extract_all(html, '<article>')) > 0 AS BOOLEAN) AS has_article,
       CAST(len(regexp_extract_all(html, '<a href="[^"]*"')) AS BIGINT) AS links FROM pages""")
def link_counts(t):
    links = F.regexp_count("html", F.lit('<a href="[^"]*"'))
    return t.pages.select(
        "page_id", F.contains("html", F.lit("<article>")).alias("has_article"), links.cast("bigint").alias("links")
    )


@query(r"""
WITH part AS (
  SELECT page_id, regexp_extract(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                                 '(?s)<article>(.*)</article>', 1) AS body FROM pages),
bold AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(body, '(?s)<h1>.*?</h1>', '', 'g'),
         '(?s)<b>.*?(</b>|(<p>)|(</p>)|$)', ' latex_metatoken \2\3', 'g'), '<[^>]*>', '', 'g') AS body
  FROM part)
SELECT page_id, CAST(len(regexp_extract_all(body, 'latex_metatoken')) AS BIGINT) AS formulas FROM bold""")
def page_metatoken(t):
    text = markup_text(F.col("html"), PAGE_RULES)
    tokens = cleanse(text)
    found = F.size(F.filter(tokens, lambda w: w == "<latex>"))
    return t.pages.select("page_id", found.cast("bigint").alias("formulas"))
