"""Analyse: topics, words, documents, layout and density of a token table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from paperloom.models import embeddings, layout as layouts, topics
from paperloom.operators.grid import grid_by_category
from paperloom.operators.phrases import detect_ngrams
from paperloom.operators.reconcile import attach_category


def topic_report(tokens: DataFrame, k: int = 3, passes: int = 50, terms: int = 3,
                 min_df: int = 1, seed: int = 0) -> DataFrame:
    """Tokens -> vectors -> LDA -> the strongest terms of each topic."""
    return topics.corpus_topics(tokens, k, passes, terms, seed, min_df=min_df)


def phrase_words(tokens: DataFrame, width: int = 100, window: int = 10, **settings):
    """Word vectors of a corpus whose phrases were merged first."""
    merged, _ = detect_ngrams(tokens)
    return embeddings.train_words(merged, width=width, window=window, **settings)


def density_by_category(vectors: DataFrame, records: DataFrame, top: int = 5, width: int = 500,
                        height: int = 500) -> DataFrame:
    """Document vectors -> 2-D layout -> points per pixel and leading category."""
    points = attach_category(layouts.layout(vectors), records)
    return grid_by_category(points, "category", top, width, height)
