"""Topic models."""

from __future__ import annotations

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.models import spread_topics
from paperloom.operators.bow import bag_of_words, term_counts, vocabulary
from paperloom.session import staged

# What MLlib takes for a vocabulary without a bound.
UNBOUNDED = (1 << 31) - 1


def count_vectors(tokens: DataFrame, min_df: float = 1.0, column: str = "tokens",
                  out: str = "features") -> tuple[CountVectorizerModel, DataFrame]:
    """Term vectors over the whole vocabulary, with no cap on its size.

    MLlib holds the vocabulary, and later topics x terms, on the driver; that is
    its own limit.
    """
    vectorizer = CountVectorizer(inputCol=column, outputCol=out, vocabSize=UNBOUNDED, minDF=min_df)
    model = vectorizer.fit(tokens)
    return model, model.transform(tokens)


def train_topics(vectors: DataFrame, k: int = 3, passes: int = 50, seed: int = 0,
                 subsampling: float = 1.0, column: str = "features"):
    """LDA by online variational Bayes.

    By default each iteration sees all documents.  With a smaller `subsampling`
    an iteration sees a sample drawn with replacement, and `passes` over the
    corpus take passes / subsampling iterations.
    """
    lda = LDA(
        k=k, maxIter=max(1, round(passes / subsampling)), optimizer="online", seed=seed,
        subsamplingRate=subsampling, featuresCol=column,
    )
    return lda.fit(vectors)


def train_spread_topics(bag: DataFrame, terms: int, k: int = 3, passes: int = 50, seed: int = 0, key: str = "doc_id",
                        concentration: float = 1.1) -> spread_topics.SpreadTopics:
    """LDA by expectation maximisation on a bag of words (document, term_id, cnt) over `terms` terms.

    Topic weights of documents and terms lie in blocks, so nothing of the size of the vocabulary is on the driver.
    The nearer `concentration` is to 1, the fewer topics a document and the fewer terms a topic has.
    """
    return spread_topics.train(bag, terms, k, passes, seed, key, concentration)


def train_corpus_topics(tokens: DataFrame, k: int = 3, passes: int = 50, seed: int = 0, key: str = "doc_id", min_df: int = 1):
    """(model, vocabulary) of a token table: terms in at least `min_df` documents, numbered by `bow.vocabulary`."""
    counts = staged(term_counts(tokens, key), "term-counts")
    vocab = staged(vocabulary(counts), "vocabulary")
    bag = bag_of_words(counts, vocab.filter(F.col("doc_freq") >= min_df), key)
    return train_spread_topics(bag, vocab.count(), k, passes, seed, key), vocab.select("term_id", "term")


def corpus_topics(tokens: DataFrame, k: int = 3, passes: int = 50, n: int = 10, seed: int = 0, key: str = "doc_id",
                  min_df: int = 1) -> DataFrame:
    """(topic, rank, term, weight) of the n strongest terms of each topic; names are joined from the vocabulary's table."""
    return topic_terms(*train_corpus_topics(tokens, k, passes, seed, key, min_df), n)


def vocabulary_table(spark, model: CountVectorizerModel) -> DataFrame:
    return spark.createDataFrame(list(enumerate(model.vocabulary)), "term_id int, term string")


def topic_terms(model, vocab: DataFrame, n: int = 10) -> DataFrame:
    """(topic, rank, term, weight) of the n strongest terms of each topic."""
    described = model.describeTopics(n)
    each = described.select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "pair")
    )
    ids = each.select(
        "topic", (F.col("rank") + 1).alias("rank"), F.col("pair.termIndices").alias("term_id"),
        F.col("pair.termWeights").alias("weight"),
    )
    return ids.join(vocab, "term_id").select("topic", "rank", "term", "weight")


def save_model(model, path: str) -> None:
    if isinstance(model, spread_topics.SpreadTopics):
        model.table.write.mode("overwrite").parquet(path)
        return
    model.write().overwrite().save(path)


def load_topics(path: str, spread: bool = False):
    """A stored model, of `train_topics` or, with `spread`, of `train_spread_topics`."""
    from pyspark.ml.clustering import LocalLDAModel

    return spread_topics.SpreadTopics(SparkSession.active().read.parquet(path)) if spread else LocalLDAModel.load(path)
