"""Parse: markup files to a token table, skipping what is already there."""

from __future__ import annotations

from pyspark.sql import DataFrame

from paperloom.functions.markup import MarkupRules
from paperloom.operators.markup import failed_documents, parse_documents, token_documents
from paperloom.operators.reconcile import pending
from paperloom.session import scratch_path
from paperloom.sources import sinks


def parse_corpus(raw: DataFrame, out: str, failures: str, done: DataFrame | None = None,
                 rules: MarkupRules = MarkupRules()) -> DataFrame:
    """raw(doc_id, xml) -> token table at `out`; failures go to their own table.

    Each document is parsed once: the parsed form is staged, as tokens and
    failures are both written from it.
    """
    spark = raw.sparkSession
    todo = raw if done is None else pending(raw, "doc_id", done)
    stage = scratch_path(spark, "parsed")
    parse_documents(todo, rules).write.parquet(stage)
    parsed = spark.read.parquet(stage)
    sinks.write_tokens(token_documents(parsed), out)
    sinks.append_failures(failed_documents(parsed), failures)
    return parsed
