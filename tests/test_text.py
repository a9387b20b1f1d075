import posixpath
import re
import string

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from paperloom.functions import fields, markup, paths, text as T
from paperloom.operators import lemmas, markup as M

RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
TEXTS = st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"),
                         max_size=40), min_size=1, max_size=60)


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, expression):
    rows = column(spark, values).select("i", expression.alias("o")).collect()
    return [r.o for r in sorted(rows, key=lambda r: r.i)]


def test_golden_tokens(spark):
    got = apply(spark, ["In 2018, x² and latex_metatoken", "1a 12 ٣٤ É"], T.cleanse("v"))
    assert got == [["in", "<num>", "x²", "and", "<latex>"], ["1a", "<num>", "<num>", "é"]]


@RELAXED
@given(TEXTS)
def test_tokens_follow_the_rule(spark, values):
    values = [v for v in values if v == v.lower() and len(v) == len(v.lower())] or ["a"]
    want = [["<num>" if re.match(r"^\d*$", w) else w for w in re.findall(r"\w+", v)] for v in values]
    got = apply(spark, values, T.cleanse("v"))
    for value, g, w in zip(values, got, want):
        # characters assigned after the JVM's Unicode version may differ
        if all(ord(c) < 0x3000 for c in value):
            assert g == w or any(c in value for c in "ࡰࡱ"), value


@RELAXED
@given(TEXTS)
def test_punctuation_and_blank_split(spark, values):
    table = str.maketrans("", "", string.punctuation)
    assert apply(spark, values, T.strip_punctuation("v")) == [v.translate(table) for v in values]
    assert apply(spark, values, T.blank_words("v")) == [v.split(" ") for v in values]
    assert apply(spark, values, T.whitespace_words("v")) == [v.split() for v in values]
    assert apply(spark, values, T.strip("v")) == [v.strip() for v in values]


@RELAXED
@given(st.lists(st.text(alphabet="ab./- ", max_size=12), min_size=1, max_size=60))
def test_stem_follows_the_rule(spark, values):
    want = [posixpath.splitext(posixpath.basename(v))[0] for v in values]
    assert apply(spark, values, paths.stem("v")) == want


def test_stop_then_punctuation(spark):
    assert apply(spark, ["The star, the."], T.stop_free_words("v", ["the"])) == [["star", "the"]]
    assert apply(spark, ["spectroscopically-confirmed X"], T.punctuation_free_words("v")) == [
        ["spectroscopicallyconfirmed", "x"]]
    assert apply(spark, ["a\nThe b b", None], T.clean_abstract("v", ["the"])) == ["a b b", None]
    assert apply(spark, ["a\nb"], T.strip_newlines("v", "")) == ["ab"]
    assert apply(spark, ["I am _x abcdefghijklmnop x2y ab"], T.simple_preprocess("v")) == [["am", "ab"]]


def test_fields(spark):
    codes = apply(spark, ["astro-ph.GA", "hep-th", None], fields.category_code("v"))
    assert codes == [4, 0, 0]
    assert apply(spark, ["hep-th"], fields.category_code("v", unmatched=None)) == [None]
    assert apply(spark, [" a  b\tc ", "", None], fields.first_category("v")) == ["a", None, None]
    assert apply(spark, ["(12)", " ", "12", "Doe (2001)", "()"], fields.is_reference_number("v")) == [
        True, True, True, False, True]
    assert apply(spark, ["2018-12-31"], fields.next_day("v")) == ["2019-01-01"]
    assert apply(spark, ["12", "x"], fields.to_number("v", strict=False)) == [12, None]
    with pytest.raises(Exception):
        apply(spark, ["x"], fields.to_number("v"))
    assert apply(spark, ["src/old_src_0003_001.tar"], paths.archive_directory("v")) == ["latex/old_src_0003_001"]
    assert apply(spark, ["astro-ph.IM x", "x astro-ph", None], fields.category_in("v", "astro-ph")) == [
        True, False, False]
    kinds = spark.createDataFrame([
        ("application/pdf", None), ("application/postscript", "x-gzip"), ("application/x-eprint-tar", "x-gzip"),
        ("application/x-eprint", "x-gzip"), ("application/x-dvi", "x-gzip"), ("application/x-dvi", None),
    ], "t string, e string").select(paths.content_kind("t", "e").alias("k"))
    assert [r.k for r in kinds.collect()] == [".pdf", ".ps.gz", ".tar.gz", ".tex", ".dvi.gz", None]


def test_lemmas(spark):
    tokens = spark.createDataFrame([(1, ["stars", "boxes", "wolves", "men", "is", "stars", "geese", "bus"]), (2, [])],
                                   "doc_id int, tokens array<string>")
    lexicon = spark.createDataFrame([(w,) for w in "star box wolf man goose bus".split()], "word string")
    odd = spark.createDataFrame([("geese", "goose")], "word string, lemma string")
    words = tokens.select(F.explode("tokens").alias("word"))
    table = lemmas.lemma_table(words, lexicon, odd)
    got = {r.doc_id: r.tokens for r in lemmas.lemmatise(tokens, table).collect()}
    assert got == {1: ["star", "box", "wolf", "man", "is", "star", "goose", "bus"], 2: []}


PAPER = """<?xml version="1.0" encoding="UTF-8"?><document xmlns="http://dlmf.nist.gov/LaTeXML">
<abstract><p>We <Math>a</Math>show <Math>b</Math></p></abstract>
<section><title>Intro</title><para>One <Math><XMTok>x</XMTok></Math>two
<cite class="ltx_citemacro_citep"><bibref bibrefs="a"/></cite>
<cite class="ltx_citemacro_citet">keep<bibref bibrefs="num"/></cite>
<cite class="ltx_citemacro_citet"><bibref bibrefs="name"/></cite>
<cite class="ltx_citemacro_cite"><bibref bibrefs="none"/></cite>
<cite class="ltx_citemacro_citet">nolabel<bibref bibrefs="bare"/></cite>
<cite>plain</cite><ERROR>e</ERROR></para>
<section><title>Sub</title><para>nested</para></section><figure><caption>c</caption></figure></section>
<bibliography><bibitem key="num"><tags><tag role="refnum">(12)</tag></tags></bibitem>
<bibitem key="name"><tags><tag role="number">1</tag><tag role="refnum">Doe (2001)</tag></tags></bibitem>
<bibitem key="name"><tag role="refnum">Second</tag></bibitem>
<bibitem key="bare"><p>x</p></bibitem></bibliography></document>"""


def test_markup_rules(spark):
    raw = spark.createDataFrame([("p", PAPER), ("q", "<d><para>only <Math/>para</para></d>"), ("e", "<d>none</d>"),
                                 ("bad", "<d><section>"), ("null", None)], "doc_id string, xml string")
    parsed = M.parse_documents(raw).cache()
    rows = {r.doc_id: r for r in parsed.collect()}
    words = " ".join(rows["p"].text.split())
    assert words == "One latex_metatoken two keep Doe (2001) nolabel plain nested"
    assert rows["q"].text == "only  latex_metatoken para" and rows["e"].text == ""
    assert rows["bad"].text is None and "ParseError" in rows["bad"].error
    counts = {r.doc_id: (r.parenthetical, r.in_text) for r in M.citation_counts(parsed).collect()}
    assert counts == {"p": (3, 1)}
    assert {r.doc_id for r in M.token_documents(parsed).collect()} == {"p", "q", "e", "null"}
    assert [r.doc_id for r in M.failed_documents(parsed).collect()] == ["bad"]
    got = raw.filter("doc_id = 'p'").select(markup.abstract_text(F.col("xml")).alias("a")).first().a
    assert got == "We show b"
    markup.register_markup_function(spark, "to_text")
    raw.createOrReplaceTempView("raw_markup")
    assert spark.sql("SELECT to_text(xml) t FROM raw_markup WHERE doc_id = 'q'").first().t == rows["q"].text


def test_html_rules(spark):
    from paperloom.queries.markup import PAGE_RULES

    page = ("<!DOCTYPE html><html><head><script>var t='</p>';</script></head><body><nav>n</nav><!-- c -->"
            "<article><h1>H</h1><p><b>bold<br><p>One &amp; two</p><p>a<b>x</b>c</p></article><footer>f</footer></html>")
    soup = "<p>first<p>second<nav>x</nav></p>"
    got = apply(spark, [page, soup], markup.markup_text(F.col("v"), PAGE_RULES))
    assert got == [" latex_metatoken One & twoa latex_metatoken c", "firstsecond"]
