"""Named queries over the star-schema and text tables, each with its SQL twin.

The tables stand in for the inputs of the workflow: documents for the corpus,
labels for ids already processed, conversations for files grouped in
submissions, orders for sized and dated archives, part names for categories.
"""

from paperloom.queries import (  # noqa: F401  (importing registers the queries)
    catalog, markup, models, reconciliation, scans, sources, streams, terms, texts, vectors,
)
from paperloom.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
