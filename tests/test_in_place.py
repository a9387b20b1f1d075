"""Token arrays stay where they are stored: no plan has an exchange that carries them."""

import re

import pytest

import __spark_entry__ as entry
from paperloom.operators import phrases, skew

QUERIES = ["phrase_apply", "phrase_report", "ngrams", "lemmatise", "normalised_words", "words_of_no_list"]


def exchanges(frame):
    """What each shuffle of a plan takes in."""
    text = frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("name", QUERIES)
def test_no_exchange_of_token_arrays(spark, monkeypatch, name, small):
    written = []

    def recorded(df, key, table="stage", buckets=None):
        if "tokens" in table or "ngrams" in table:
            written.append((table, df))
        return store(df, key, table, buckets)

    store = phrases.staged_by
    monkeypatch.setattr(phrases, "staged_by", recorded)
    if not small:  # tables that are too large to be sent to every task
        for place in (phrases, skew):
            monkeypatch.setattr(place, "fits_broadcast", lambda *a: False, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760" if small else "-1")
    try:
        frame = entry.queries()[name](spark, "/root/testdata/sf0.001")
        plans = [frame] + [df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id") for _, df in written]
        for plan in plans:
            assert not any(re.search(r"\btokens#", moved) for moved in exchanges(plan)), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
