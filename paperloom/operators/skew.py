"""Lookups that stay balanced when some keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MAX_HEAVY = 512
SALTS = 32
# Rows of one key that a task should hold, keys that a sketch follows, and how many of them may count as heavy.
TASK_ROWS, TRACKED, MOST_HEAVY = 1_000_000, 1 << 17, 1 << 14
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 << 20


def heavy_keys(facts: DataFrame, keys, weight: Column | None = None,
               max_keys: int = MAX_HEAVY) -> DataFrame:
    """Keys that hold more than 1/max_keys of the rows (or of the weight).

    Fewer than `max_keys` keys can do so, whatever the size of the table, so the
    result is safe to broadcast.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = F.lit(1) if weight is None else weight
    counts = facts.groupBy(*keys).agg(F.sum(w).alias("_n"))
    total = facts.agg(F.sum(w)).scalar()
    return counts.filter(F.col("_n") * max_keys > total).select(*keys)


def heavy_hitters(facts: DataFrame, keys, task_rows: int = TASK_ROWS) -> DataFrame:
    """(_key, _salts): hashes of the keys with more rows than a task should hold, and how many tasks' worth they have.

    Rows are counted by a frequent-items sketch of fixed size: each task fills one, and these are merged, so nothing
    is shuffled by key.  The sketch misses no key with more than one in `MOST_HEAVY` of the rows; in a table so
    large that this is more than `task_rows`, that is what a task holds.  So there are at most `MOST_HEAVY` rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    seen = facts.select(F.xxhash64(*keys).alias("_key")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(_key, {MOST_HEAVY}, {TRACKED})").alias("top")).first()
    hold = max(task_rows, seen.n // MOST_HEAVY)
    found = [(item["item"], -(-item["count"] // hold)) for item in seen.top or [] if item["count"] > hold]
    return facts.sparkSession.createDataFrame(found, "_key bigint, _salts bigint")


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory: text by its bytes, the rest by fixed widths."""
    total = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0)) + 16
        elif isinstance(f.dataType, T.ArrayType):
            total = total + F.greatest(F.size(f.name), F.lit(0)) * 8 + 16
        else:
            total = total + 8
    return total.cast("bigint")


def fits_broadcast(dim: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True if the table is within both bounds; reading stops just beyond the row bound."""
    seen = dim.limit(rows + 1).agg(F.count("*").alias("n"), F.sum(_row_bytes(dim)).alias("b")).first()
    return seen.n <= rows and (seen.b or 0) <= size


def lookup(facts: DataFrame, dim: DataFrame, keys, salt_by: list, heavy: DataFrame | None = None,
           how: str = "inner", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join `facts` to `dim`, which is unique on `keys`.

    The size of `dim` is measured first (it should be a stored table).  Within
    the row and byte bounds it is sent to every task and `facts` do not move;
    beyond them the join is a shuffle with heavy keys spread over salts.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if fits_broadcast(dim, broadcast_rows):
        return facts.join(F.broadcast(dim), keys, how)
    if heavy is None:
        heavy = heavy_hitters(facts, keys)
    return salted_lookup(facts, dim, keys, heavy, salt_by, how)


def salted_lookup(
    facts: DataFrame, dim: DataFrame, keys, heavy: DataFrame, salt_by: list,
    how: str = "inner", salts: int = SALTS, partitions: int | None = None,
) -> DataFrame:
    """Join `facts` to `dim` (unique on `keys`) with heavy keys spread over salts.

    `heavy` names keys, by their columns or by `_key`, the hash of these; its column `_salts` says how many salts each
    gets, `salts` without it.  Rows of a heavy key get a salt from a hash of `salt_by`; the one matching dimension row
    is repeated once per salt.  Only heavy dimension rows are repeated, so `dim` grows by no more rows than heavy keys
    have salts.  The salt is a hash, not a random number: a task that is run again gives the same rows.  `partitions`
    says how many tasks the rows are dealt to, where what they find is much wider than they are.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    named = heavy if "_key" in heavy.columns else heavy.withColumn("_key", F.xxhash64(*keys))
    many = F.col("_salts") if "_salts" in heavy.columns else F.lit(salts).cast("bigint")
    marks = F.broadcast(named.groupBy("_key").agg(F.max(many).alias("_salts")))

    def marked(df):
        return df.withColumn("_key", F.xxhash64(*keys)).join(marks, "_key", "left").drop("_key")

    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*salt_by), F.col("_salts"))).otherwise(F.lit(0).cast("bigint"))
    left = marked(facts).withColumn("_salt", salt).drop("_salts")
    if partitions:
        left = left.repartition(partitions, *keys, "_salt")
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1)
    right = marked(dim).withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
