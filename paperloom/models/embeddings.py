"""Word and document vectors."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.models import skipgram
from paperloom.models.word_means import TASK_BYTES, SpreadTable, document_means, tasks_for, vector_table, weighted_means
from paperloom.operators.bow import each_token, term_counts
from paperloom.operators.similarity import nearest, vector_of
from paperloom.operators.skew import heavy_hitters, salted_lookup
from paperloom.operators.word_codes import rows_by_key
from paperloom.session import staged


class WordVectors:
    """A model of word vectors: the stored table (word, vector) with float arrays."""

    def __init__(self, table: DataFrame):
        self.table = table

    def getVectors(self) -> DataFrame:
        return self.table.select("word", array_to_vector("vector").alias("vector"))


def train_words(tokens: DataFrame, width: int = 300, window: int = 5, min_count: int = 5,
                iterations: int = 10, partitions: int | None = None, seed: int = 0,
                column: str = "tokens") -> WordVectors:
    """Skip-gram word vectors.

    `partitions` sets how many blocks of the vocabulary train side by side; by
    default as many as the tokens have partitions.  Give a number for a result
    that does not depend on how the tokens are stored.  Parameters lie in blocks
    (`paperloom.models.skipgram`), so words may be any number.
    """
    if partitions is None:
        partitions = max(1, tokens.rdd.getNumPartitions())
    return WordVectors(skipgram.train(tokens, width, window, min_count, iterations, partitions, seed, column))


def word_table(model: WordVectors) -> DataFrame:
    """(word, vector) with float arrays."""
    return model.table


def neighbours(model: WordVectors, word: str, n: int = 10) -> DataFrame:
    """(word, similarity): the n words closest to a word by cosine."""
    if vector_of(model.table, word, "word").isEmpty():
        raise ValueError(f"{word} is not in the vocabulary")
    return nearest(model.table, word, n, "word")


def document_vectors(tokens: DataFrame, words: DataFrame, key: str = "doc_id", column: str = "tokens",
                     weights: DataFrame | None = None) -> DataFrame:
    """(doc_id, vector): mean of the vectors of a document's words.

    A word counts as often as it occurs; `weights` (word, weight), such as idf, scales it.  Documents without a known
    word get a null vector.  A document's vectors are summed where it is read.  A table of words of up to
    `word_codes.TABLE_BYTES` is sent to every task; a larger one is stored in blocks, which tasks read one after another.
    Vectors of different widths, or with null components, are joined.
    """
    table = words.select("word", "vector").filter("word IS NOT NULL AND vector IS NOT NULL")
    if weights is None:
        table = table.withColumn("weight", F.lit(1.0))
    else:
        table = table.join(weights.select("word", F.col("weight").cast("double").alias("weight")), "word")
    held = vector_table(table)
    if held is None:
        return _joined_vectors(tokens, table, key, column)
    rows, repeated = rows_by_key(tokens.select(key, column), key)
    vector = F.when(F.col(key).isNotNull(), F.col("vector")).alias("vector")
    made = document_means(rows, held, key, column).select(key, vector)
    if repeated is None:
        return made
    parts = staged(document_means(repeated, held, key, column), "row-means")
    known = parts.filter("n > 0")
    width = (held if isinstance(held, SpreadTable) else held.value).width
    tasks = tasks_for(known.count(), width, _shuffles(tokens))
    return made.unionByName(parts.select(key).join(weighted_means(known, key, tasks), key, "left"))


def _shuffles(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _joined_vectors(tokens: DataFrame, table: DataFrame, key: str, column: str) -> DataFrame:
    """`document_vectors` for any table (word, vector, weight).

    Every count meets its word's vector, so counts and what they find are dealt to as many tasks as their number asks for.
    """
    counts = staged(term_counts(tokens, key, column).select(key, F.col("token").alias("word"), "cnt"), "counts")
    width = table.agg(F.max(F.size("vector"))).first()[0] or 0
    tasks = tasks_for(counts.count(), width, _shuffles(tokens))
    heavy = heavy_hitters(counts, "word", TASK_BYTES // (8 * width + 96))
    table = table.withColumn("vector", F.col("vector").cast("array<double>"))
    found = salted_lookup(counts, table, "word", heavy, [key], partitions=tasks)
    vectors = weighted_means(found.select(key, "vector", (F.col("cnt") * F.col("weight")).alias("n")), key, tasks)
    return tokens.select(key).join(vectors, key, "left")


def infer_vectors(model: WordVectors, tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Vectors of documents, seen or unseen, by a trained model.

    The model's words are looked up as in `document_vectors`, so they may be of any size.
    """
    return document_vectors(tokens, word_table(model), key)


def idf_weights(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """(word, weight): log((documents + 1) / (documents with the word + 1))."""
    total = tokens.agg(F.count("*")).scalar()
    distinct = tokens.select(F.array_distinct(column).alias("words"))
    seen = each_token(distinct, column="words").withColumnRenamed("token", "word")
    return seen.groupBy("word").agg(F.count("*").alias("df")).select(
        "word", F.log((total + 1) / (F.col("df") + 1)).alias("weight")
    )


def save_words(model: WordVectors, path: str) -> None:
    """The model's vectors as a table."""
    word_table(model).write.mode("overwrite").parquet(f"{path}/vectors")


def load_words(path: str) -> WordVectors:
    return WordVectors(SparkSession.active().read.parquet(f"{path}/vectors"))


def words_or_train(tokens: DataFrame, path: str, **settings) -> WordVectors:
    """Load the stored model if there is one, else train and store it."""
    try:
        return load_words(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
    model = train_words(tokens, **settings)
    save_words(model, path)
    return model


__all__ = [
    "WordVectors", "document_vectors", "idf_weights", "infer_vectors", "load_words",
    "neighbours", "save_words", "train_words", "word_table", "words_or_train",
]
