"""A corpus pipeline: language ID, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each one's result as Parquet in the
shared folder and hands it, read again, to the next.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.llm import decontamination, jaccard_join, language_id, packing, suffix_dedup
from paperloom.llm.common import bounded_batches, read_table, staged
from paperloom.llm.queries import held_out, tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _learned(docs):
    return language_id.train(docs.withColumn("held_out", held_out()).where("not held_out").select("lang", "text"))


def identify_language(spark, docs, sf_dir):
    """Documents whose language the models recognise; those they reject go."""
    scored = language_id.score(docs.select(*COLUMNS), _learned(docs), keep_text=True)
    return scored.where("not rejected").select(*COLUMNS)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates: that of the least doc_id, once per text.  Rows without a doc_id stay."""
    groups = jaccard_join.near_duplicate_components(docs.select("doc_id", "text"))
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.select(*COLUMNS).where("doc_id is not null").join(first, "doc_id", "left_semi")
    # the join has dealt rows by doc_id, so repeated rows meet without another shuffle
    once = named.withColumn("mark", F.xxhash64("text")).dropDuplicates(["doc_id", "mark"]).drop("mark")
    return once.unionByName(docs.select(*COLUMNS).where("doc_id is null"))


def cut_repeats(spark, docs, sf_dir):
    """Texts without the passages that stand elsewhere too; texts of nothing else go."""
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS))
    return cut.where("text is not null and (text <> '' or n_chars = 0)").select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def drop_benchmark_leaks(spark, docs, sf_dir):
    """Documents without passages of the benchmark."""
    items = read_table(spark, sf_dir, "benchmark")
    return decontamination.clean(docs.select(*COLUMNS), items)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of training sequences with their token ids."""
    return packing.pack(docs.select("doc_id", "text"), tokenizer("byte_bpe_50k.json"), keep_encoder=False)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("packing", pack_sequences),
]
# Models, automata and suffix order are not expressible in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The packed pieces of the documents that pass all stages."""
    bounded_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return staged(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
