import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from paperloom.llm.queries import tokenizer
from tests.llm.helpers import awkward, docs, sentence


def planted(seed=11):
    rng = random.Random(seed)
    clean = [(k, sentence(rng, rng.randint(40, 120)), "en") for k in range(60)]
    base = sentence(rng, 100)
    near = [(100 + k, base.replace(" ", f" v{k} ", 1), "en") for k in range(4)]
    passage = sentence(rng, 60)
    shared = [(200 + k, f"{sentence(rng, 50)} {passage} {sentence(rng, 50)}", "en") for k in range(3)]
    bench = [(1, sentence(rng, 40)), (2, sentence(rng, 45))]
    leaks = [(300 + k, f"{sentence(rng, 60)} {bench[k][1]} {sentence(rng, 60)}", "en") for k in range(2)]
    junk = [(400, "12 34 !!", "en"), (401, None, "en"), (402, "", None)]
    return clean, near, passage, shared, bench, leaks, junk


def test_planted_cases(spark, tmp_path):
    clean, near, passage, shared, bench, leaks, junk = planted()
    folder = str(tmp_path)
    table = docs(spark, clean + near + shared + leaks + junk)
    table.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    stages, now = {}, table
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, now, folder).write.parquet(path)
        now = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == table.columns
        stages[name] = {r.doc_id: r for r in now.select("doc_id", *(["text"] if "text" in now.columns else [])).collect()}
    first = stages["language_id"]
    assert set(first) == {r[0] for r in clean + near + shared + leaks}
    second = stages["near_duplicates"]
    assert set(second) == set(first) - {101, 102, 103}
    third = stages["repeated_passages"]
    assert all(third[k].text == text for k, text, _ in clean)
    assert all(passage not in third[k].text and third[k].text for k, _, _ in shared)
    assert set(third) - set(stages["benchmark_leaks"]) == {300, 301}
    packed = now.toPandas()
    assert set(packed.doc_id) == set(stages["benchmark_leaks"])


def test_run_gives_the_last_stage(spark, tmp_path):
    clean, near, _, shared, bench, leaks, junk = planted(3)
    folder = str(tmp_path)
    docs(spark, clean + near + shared + leaks + junk, clashing=True).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    pieces = corpus_pipeline.run(spark, folder).toPandas()
    for k, text, _ in clean:
        own = pieces[pieces.doc_id == k].sort_values("start")
        assert np.frombuffer(b"".join(own.ids), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids + [1]


def test_awkward_and_empty_tables(spark, tmp_path):
    for part, rows in (("some", awkward()), ("none", [])):
        folder = str(tmp_path / part)
        docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, None), (None, "x")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        assert (corpus_pipeline.run(spark, folder).count() > 0) == bool(rows)


def test_one_row_stays_of_copies(spark, tmp_path):
    same = sentence(random.Random(1), 50)
    table = docs(spark, [(5, same), (3, same), (3, same), (9, "other text of its own")])
    kept = corpus_pipeline.drop_near_duplicates(spark, table, "").select(F.col("doc_id")).collect()
    assert sorted(r.doc_id for r in kept) == [3, 9]
