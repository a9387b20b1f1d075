"""What was expected, obtained, converted and is still pending.

Semi and anti joins leave the choice of broadcast or shuffle to Spark, which
knows the sizes; no side is forced.  Where only presence matters the inputs are
merged with an aggregate instead of an outer join: it combines rows before the
shuffle, so repeated ids cost nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom.functions.fields import first_category
from paperloom.functions.paths import base_name, stem
from paperloom.operators.skew import lookup
from paperloom.operators.windows import first_per_group
from paperloom.session import staged

# Characters of the grams that substring membership looks identifiers up by, and what a cell of a frequent gram holds.
GRAM = 6
CELL_IDS, CELL_TEXTS = 1024, 16_384


def known_members(members: DataFrame, identifiers: DataFrame, member_key: str = "submission_id",
                  id_key: str = "filename_parsed") -> DataFrame:
    """Members whose id is a known identifier."""
    ids = identifiers.select(F.col(id_key).alias(member_key))
    return members.join(ids, member_key, "left_semi")


def contained_members(members: DataFrame, identifiers: DataFrame, member_key: str = "submission_id",
                      id_key: str = "filename_parsed", dot_is_wildcard: bool = True) -> DataFrame:
    """Members whose id occurs inside some identifier.

    With `dot_is_wildcard` a dot in the member id matches any one character, as
    it does in a regular expression; every other character stands for itself.

    Identifiers are looked up by grams, stretches of up to `GRAM` characters.  Grams that members have are counted over all
    identifiers, and a member is looked up at its rarest one; wildcards leave grams out.  A member that has a gram that no
    identifier has is done, and so is one that is a gram itself.  The others meet the identifiers of their rarest gram,
    where the full test is made inside a semi join; a gram that many have on both sides is split into a grid of cells,
    so that a cell holds no more than `CELL_IDS` members and `CELL_TEXTS` identifiers on average.
    """
    named = members.select(F.col(member_key).alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    texts = staged(identifiers.select(F.col(id_key).alias("_text")).filter(F.col("_text").isNotNull()).distinct(), "identifiers")

    stretches = F.split("_id", r"\.") if dot_is_wildcard else F.array("_id")
    longest = F.array_max(F.transform(stretches, lambda s: F.length(s)))
    test = F.contains("_text", "_id")
    pattern = F.lit(None).cast("string")
    if dot_is_wildcard:
        # each stretch is quoted, so only the dots keep a special meaning
        pattern = F.concat(F.lit(r"(?s)\Q"), F.array_join(stretches, r"\E[^\n]\Q"), F.lit(r"\E"))
        test = F.expr("_text rlike _pattern")
    size = F.least(longest, F.lit(GRAM))
    ids = staged(named.select("_id", pattern.alias("_pattern"), size.alias("_size"),
                              F.array_distinct(F.flatten(F.transform(stretches, lambda s: _grams(s, F.array(size))))).alias("_grams")), "members")

    # ids that are empty or all wildcards only ask for an identifier long enough
    longest_text = texts.agg(F.max(F.length("_text"))).scalar()
    bare = ids.filter((F.col("_size") == 0) & (F.length("_id") <= longest_text)).select("_id")

    id_grams = ids.select("_id", F.explode("_grams").alias("_gram"))
    sizes = ids.filter("_size > 0").agg(F.coalesce(F.collect_set("_size"), F.array().cast("array<int>"))).scalar()  # at most GRAM

    def text_grams(columns, kept):
        cut = texts.withColumn("_sizes", sizes).select(*columns, F.explode(F.array_distinct(_grams(F.col("_text"), F.col("_sizes")))).alias("_gram"))
        return cut.join(kept, "_gram", "left_semi")

    counts = staged(text_grams([], id_grams.select("_gram").distinct()).groupBy("_gram").agg(F.count("*").alias("_texts")), "gram-counts")
    met = lookup(id_grams, counts, "_gram", ["_id"], how="left")
    rarest = met.groupBy("_id").agg(F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("_texts"), "_gram")).alias("_r")).filter("_r._texts > 0")
    looked = staged(rarest.select("_id", "_r.*").join(ids.select("_id", "_pattern"), "_id"), "rarest")
    itself = looked.filter(F.col("_gram") == F.col("_id")).select("_id")

    asked = looked.filter(F.col("_gram") != F.col("_id"))
    grid = staged(asked.groupBy("_gram").agg(F.count("*").alias("_ids"), F.first("_texts").alias("_texts")).select(
        "_gram", F.ceil(F.col("_ids") / CELL_IDS).alias("_rows"), F.ceil(F.col("_texts") / CELL_TEXTS).alias("_columns")), "gram-grid")
    some = lookup(text_grams(["_text"], grid.select("_gram")), grid, "_gram", ["_text"])
    some = some.select("_gram", "_text", F.pmod(F.xxhash64("_text"), "_columns").alias("_column"),
                       F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_rows") - 1)).alias("_row"))
    asking = lookup(asked.drop("_texts"), grid, "_gram", ["_id"])
    asking = asking.select("_gram", "_id", "_pattern", F.pmod(F.xxhash64("_id"), "_rows").alias("_row"),
                           F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_columns") - 1)).alias("_column"))
    same = (asking["_gram"] == some["_gram"]) & (asking["_row"] == some["_row"]) & (asking["_column"] == some["_column"])
    matched = asking.join(some, same & test, "left_semi").select("_id")

    found = itself.unionByName(matched).unionByName(bare).select(F.col("_id").alias(member_key))
    return members.join(found, member_key, "left_semi")


def _grams(text, sizes):
    """All stretches of a text of the given sizes."""
    return F.flatten(F.transform(
        F.filter(sizes, lambda n: (n > 0) & (n <= F.length(text))),
        lambda n: F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda at: F.substring(text, at, n))))


def pending(work: DataFrame, key: str, *done: DataFrame, done_key: str | None = None) -> DataFrame:
    """Work whose key appears in none of the `done` tables (outputs, logs, mirrors)."""
    for table in done:
        work = work.join(table.select(F.col(done_key or key).alias(key)), key, "left_anti")
    return work


def source_tier(keys: DataFrame, local: DataFrame, mirror: DataFrame, path: str = "path",
                title: str = "title") -> DataFrame:
    """Where to take each archive from: local copy, else mirror, else origin.

    A mirror may list one title several times; its last entry by id is used.
    """
    wanted = keys.withColumn("_name", base_name(path))
    here = local.select(base_name(path).alias("_name")).distinct().withColumn("_local", F.lit(True))
    there = mirror.groupBy(F.col(title).alias("_name")).agg(F.max("id").alias("mirror_id"))
    tier = (
        F.when(F.col("_local"), "local").when(F.col("mirror_id").isNotNull(), "mirror")
        .otherwise("origin")
    )
    return (
        wanted.join(here, "_name", "left").join(there, "_name", "left")
        .withColumn("tier", tier).drop("_name", "_local")
    )


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids found on one side only, with the side and the number of rows it has.

    A single grouped count over both inputs answers both directions at once.
    """
    sides = left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counts = sides.groupBy(key).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    one_sided = counts.filter((F.col("_l") == 0) | (F.col("_r") == 0))
    return one_sided.select(
        key,
        F.when(F.col("_r") == 0, "left").otherwise("right").alias("side"),
        (F.col("_l") + F.col("_r")).alias("copies"),
    )


def missing_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of `left` whose id `right` lacks; repeats are kept."""
    return left.join(right.select(key), key, "left_anti")


def missing_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct ids of `left` that `right` lacks."""
    return left.select(key).subtract(right.select(key))


def attach_category(layout: DataFrame, records: DataFrame, key: str = "doc_id",
                    record_key: str = "filename_parsed") -> DataFrame:
    """Primary category for every point, matched by id; null where unknown."""
    categories = records.select(
        F.col(record_key).alias(key), first_category("categories").alias("category")
    )
    unique = categories.groupBy(key).agg(F.min("category").alias("category"))
    return layout.join(unique, key, "left")


def corpus_categories(records: DataFrame, corpus: DataFrame, record_key: str = "filename_parsed",
                      corpus_key: str = "doc_id") -> DataFrame:
    """Records present in the corpus, with their first category."""
    present = corpus.select(F.col(corpus_key).alias(record_key))
    return records.join(present, record_key, "left_semi").withColumn(
        "category", first_category("categories")
    )


def conversion_outcome(submissions: DataFrame, logs: DataFrame, outputs: DataFrame,
                       key: str = "submission_id") -> DataFrame:
    """State of each id seen anywhere: `converted`, `failed` or `pending`.

    An output means converted, a log without output means failed.
    """
    def flag(df, logged, made):
        return df.select(key, F.lit(logged).alias("_log"), F.lit(made).alias("_out"))

    seen = flag(submissions, False, False).unionByName(flag(logs, True, False)).unionByName(
        flag(outputs, False, True)
    )
    state = seen.groupBy(key).agg(F.bool_or("_log").alias("_log"), F.bool_or("_out").alias("_out"))
    return state.select(
        key,
        F.when(F.col("_out"), "converted").when(F.col("_log"), "failed")
        .otherwise("pending").alias("outcome"),
    )


def restart_archives(log: DataFrame, outputs: DataFrame, unpacked: DataFrame | None = None) -> DataFrame:
    """Archives with a logged submission that has no output.

    `unpacked` (column `tarfile`) limits the answer to archives still unpacked.
    """
    open_ = log.join(outputs.select("submission_id"), "submission_id", "left_anti")
    archives = open_.select("tarfile").filter(F.col("tarfile").isNotNull()).distinct()
    return archives if unpacked is None else archives.join(unpacked.select("tarfile"), "tarfile", "left_semi")


def empty_submissions(submissions: DataFrame, files: DataFrame, key: str = "submission_id") -> DataFrame:
    """Submissions without a source file."""
    return submissions.join(files.select(key), key, "left_anti")


def unconverted(submissions: DataFrame, outputs: DataFrame, logs: DataFrame,
                path: str = "path") -> DataFrame:
    """Submissions with neither an output nor a log, matched on the full id."""
    keyed = submissions.withColumn("submission_id", stem(path))
    return pending(keyed, "submission_id", outputs, logs)


__all__ = [
    "attach_category", "contained_members", "conversion_outcome", "corpus_categories",
    "empty_submissions", "known_members", "missing_ids", "missing_rows", "pending", "reconcile",
    "restart_archives", "source_tier", "unconverted",
]
