"""Text normalisation as column expressions.

Nothing here shuffles: every function maps one string (or token array) to
another, so a scan, its normalisation and a following explode stay in one stage.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession, functions as F

from paperloom import constants as C


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def word_runs(text) -> Column:
    """Lower-cased runs of word characters (letters, numbers, underscore)."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(f"({C.WORD_CHARS}+)"), F.lit(1))


def meta_tokens(tokens) -> Column:
    """Digits become the number token, the math word becomes the math token."""
    return F.transform(
        _col(tokens),
        # every digit sorts outside ':' .. FIRST_OTHER_DIGIT, so most words skip the regex
        lambda t: F.when(
            ((t < ":") | (t >= C.FIRST_OTHER_DIGIT)) & t.rlike(C.DIGITS_ONLY), C.NUMBER_TOKEN
        )
        .when(t == C.MATH_WORD, C.MATH_TOKEN)
        .otherwise(t),
    )


def cleanse(text) -> Column:
    """Text -> normalised tokens: `word_runs` followed by `meta_tokens`."""
    return meta_tokens(word_runs(text))


def whitespace_words(text) -> Column:
    """Words between runs of any Unicode white space, never empty ones."""
    return F.filter(F.split(_col(text), C.WHITESPACE + "+"), lambda w: w != "")


def strip(text) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(_col(text), F.lit(C.WHITESPACE_TRIMMED))


def blank_words(text) -> Column:
    """Split at each single blank; empty words between two blanks are kept."""
    return F.split(_col(text), " ", -1)


def drop_stopwords(words, stopwords: Iterable[str]) -> Column:
    """Remove listed words, keeping repeats and order of the others.

    The list is a parameter of bounded size; `isin` compiles to a hash-set probe.
    """
    listed = sorted(set(stopwords))
    if not listed:
        return _col(words)
    return F.filter(_col(words), lambda w: ~w.isin(listed))


def strip_punctuation(text) -> Column:
    """Delete the ASCII punctuation characters; `a-b` becomes `ab`."""
    return F.translate(_col(text), C.ASCII_PUNCTUATION, "")


def strip_newlines(text, replacement: str = " ") -> Column:
    """Newlines to blanks; `replacement=''` glues lines together."""
    return F.replace(_col(text), F.lit("\n"), F.lit(replacement))


def simple_preprocess(text, shortest: int = 2, longest: int = 15) -> Column:
    """Lower-cased alphabetic runs of bounded length, none starting with `_`."""
    runs = F.regexp_extract_all(
        F.lower(_col(text)), F.lit(f"({C.ALPHABETIC_CHARS}+)"), F.lit(1)
    )
    return F.filter(
        runs,
        lambda w: F.length(w).between(shortest, longest) & ~w.startswith("_"),
    )


def punctuation_free_words(text, lower: bool = True) -> Column:
    """Punctuation deleted, then white-space words: the document-vector tokens."""
    plain = strip_punctuation(text)
    return whitespace_words(F.lower(plain) if lower else plain)


def stop_free_words(text, stopwords: Iterable[str]) -> Column:
    """Lower, remove stopwords, then delete punctuation.

    Stopwords go first, so `the,` outlives a list holding `the` and comes out as
    `the`.  Lemmas are attached by `paperloom.operators.lemmas`.
    """
    kept = drop_stopwords(whitespace_words(F.lower(_col(text))), stopwords)
    plain = F.transform(kept, strip_punctuation)
    return F.filter(plain, lambda w: w != "")


def clean_abstract(text, stopwords: Iterable[str]) -> Column:
    """One blank-joined line of lower-cased, stopword-free words; null stays null."""
    words = whitespace_words(F.lower(strip_newlines(text)))
    return F.array_join(drop_stopwords(words, stopwords), " ")


def singular_forms(word) -> Column:
    """What the noun ending rules make of a word, in rule order; may be empty."""
    w = _col(word)
    forms = [
        F.when(
            w.endswith(ending),
            F.concat(F.left(w, F.length(w) - len(ending)), F.lit(replacement)),
        )
        for ending, replacement in C.NOUN_ENDINGS
    ]
    return F.filter(F.array(*forms), lambda f: f.isNotNull() & (f != ""))


def noun_rule_candidates(word, rounds: int = 3) -> Column:
    """(round, form) structs in order of preference.

    Round 1 holds the word itself and its singular forms; each further round,
    used only where no earlier form is a known noun, applies the rules again.
    """
    w = _col(word)
    forms = singular_forms(w)
    steps = [F.concat(F.array(w), forms)]
    for _ in range(rounds - 1):
        forms = F.flatten(F.transform(forms, singular_forms))
        steps.append(forms)

    def numbered(step, n):
        return F.transform(step, lambda f: F.struct(F.lit(n).alias("round"), f.alias("form")))

    return F.concat(*[numbered(step, n) for n, step in enumerate(steps, 1)])


def default_stopwords(spark: SparkSession, language: str = "english") -> list[str]:
    """The stop list shipped with Spark."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords(language)
