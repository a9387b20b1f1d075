"""Large groups: salted lookups, chunked fills, deep top-k and dense ids against plain answers."""

import random
import re

from pyspark.sql import Window, functions as F

from paperloom.operators import indexing, reconcile, sets, skew, topk, windows


def hot_rows(spark, n=3000):
    random.seed(3)
    rows = [(i, "hot" if random.random() < 0.4 else f"k{random.randrange(60)}") for i in range(n)]
    rows += [(n, None), (n + 1, "nowhere")]
    return spark.createDataFrame(rows, "id int, k string")


def test_salted_lookup_equals_join(spark):
    facts = hot_rows(spark)
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(50)], "k string, v int")
    heavy = skew.heavy_keys(facts, "k", max_keys=10)
    assert [r.k for r in heavy.collect()] == ["hot"]
    for how in ("inner", "left"):
        got = skew.salted_lookup(facts, dim, "k", heavy, ["id"], how)
        want = facts.join(dim, "k", how)
        assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(
            map(str, want.select("id", "k", "v").collect()))
        forced = skew.lookup(facts, dim, "k", ["id"], how=how, broadcast_rows=5)
        assert forced.count() == want.count()


def test_salted_rows_are_spread(spark):
    facts = hot_rows(spark)
    heavy = skew.heavy_keys(facts, "k", max_keys=10)
    dim = spark.createDataFrame([("hot", 1)], "k string, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_lookup(facts, dim, "k", heavy, ["id"])
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) >= 6


def test_salts_follow_measured_weights(spark):
    """One key far above what a task should hold, and hundreds just under one in 512 of the rows."""
    rows = [(k, -1) for k in range(60_000)] + [(k, k % 400) for k in range(60_000, 136_000)]
    facts = spark.createDataFrame(rows, "id long, k long").repartition(6)
    assert 76_000 / 400 < len(rows) / 512
    hitters = {r._key: r._salts for r in skew.heavy_hitters(facts, "k", task_rows=1000).collect()}
    assert list(hitters.values()) == [60]
    fine = skew.heavy_hitters(facts, "k", task_rows=50)
    assert sorted(r._salts for r in fine.collect()) == [4] * 400 + [1200]
    dim = spark.createDataFrame([(k, k * 2) for k in range(-1, 390)], "k long, v long")
    for how in ("inner", "left"):
        got = skew.salted_lookup(facts, dim, "k", fine, ["id"], how)
        assert got.select("id", "k", "v").exceptAll(facts.join(dim, "k", how).select("id", "k", "v")).count() == 0
        assert got.count() == facts.join(dim, "k", how).count()
    two = skew.heavy_hitters(facts.withColumn("j", F.lit("x")), ["k", "j"], task_rows=10_000)
    assert [r._salts for r in two.collect()] == [6]
    assert skew.heavy_hitters(facts.limit(0), "k").count() == 0


def test_fill_forward_one_hot_group(spark):
    random.seed(5)
    rows = [("a" if random.random() < 0.7 else "b", i, str(i) if random.random() < 0.02 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, line int, v string")
    got = windows.fill_forward(df, ["g"], F.floor(F.col("line") / 100), "line", "v", "filled")
    window = Window.partitionBy("g").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("filled", F.last("v", ignorenulls=True).over(window))
    key = ["g", "line", "filled"]
    assert sorted(map(str, got.select(*key).collect())) == sorted(map(str, want.select(*key).collect()))


def test_dense_index_is_dense_and_ordered(spark):
    words = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("w"))
    got = [(r.i, r.w) for r in indexing.dense_index(words, ["w"], "i").collect()]
    assert sorted(got) == list(enumerate(sorted(w for _, w in got)))


def test_top_k_beyond_the_group_limit(spark):
    df = spark.range(6000).select("id", (F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 6007).alias("n"))
    got = topk.top_k_per_group(df, ["g"], [F.desc("n"), F.asc("id")], 1500)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("n"), F.asc("id"))))
    assert sorted(map(tuple, got.select("g", "id", "rank").collect())) == sorted(
        map(tuple, want.filter("rank <= 1500").select("g", "id", "rank").collect()))


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("g"))
    plan = topk.top_k_per_group(df, ["g"], [F.desc("id")], 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_contained_members_brute_force(spark):
    random.seed(11)
    texts = ["".join(random.choice("ab.1") for _ in range(random.randrange(0, 50))) for _ in range(120)]
    ids = ["".join(random.choice("ab.1") for _ in range(random.randrange(0, 7))) for _ in range(200)]
    ids += [t[5:45] for t in texts if len(t) > 45][:20] + ["", ".", "." * 49, "." * 60, "[a", "a+"]
    members = spark.createDataFrame([(i,) for i in ids], "submission_id string")
    known = spark.createDataFrame([(t,) for t in texts] + [(None,)], "filename_parsed string")

    def matches(i, t, wildcard):
        return any(
            all(c == t[s + k] or (wildcard and c == ".") for k, c in enumerate(i))
            for s in range(len(t) - len(i) + 1)
        )

    for wildcard in (True, False):
        want = sorted(i for i in ids if any(matches(i, t, wildcard) for t in texts))
        got = reconcile.contained_members(members, known, dot_is_wildcard=wildcard)
        assert sorted(r.submission_id for r in got.collect()) == want
        plan = got._jdf.queryExecution().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_members_of_one_long_start(spark, monkeypatch):
    """Ids that all share a start longer than any gram are told apart by what is rare in them."""
    monkeypatch.setattr(reconcile, "CELL_IDS", 16)
    monkeypatch.setattr(reconcile, "CELL_TEXTS", 8)
    start = "https://archive.example.org/abstracts/of/"
    assert len(start) > 40
    texts = [f"{start}{k:05d}v{k % 3}" for k in range(400)]
    ids = [f"{start}{k:05d}" for k in range(0, 800, 5)] + [f"{start}.....v2", f"{start}....0v1", f"{start}9...."]
    members = spark.createDataFrame([(i,) for i in ids], "submission_id string")
    known = spark.createDataFrame([(t,) for t in texts], "filename_parsed string")
    got = [r.submission_id for r in reconcile.contained_members(members, known).collect()]
    assert sorted(got) == sorted([f"{start}{k:05d}" for k in range(0, 400, 5)] + [f"{start}.....v2", f"{start}....0v1"])


def test_frequent_grams_are_split_into_cells(spark, monkeypatch):
    monkeypatch.setattr(reconcile, "CELL_IDS", 16)
    monkeypatch.setattr(reconcile, "CELL_TEXTS", 8)
    texts = [f"abcdef-{'x' * (k % 9)}{k}" for k in range(300)]
    ids = [f"abcdef.{'x' * n}.{d}" for n in range(12) for d in range(10)]
    members = spark.createDataFrame([(i,) for i in ids], "submission_id string")
    known = spark.createDataFrame([(t,) for t in texts], "filename_parsed string")
    want = sorted(i for i in ids if any(re.search(i.replace("-", "[-]"), t) for t in texts))
    got = reconcile.contained_members(members, known)
    assert sorted(r.submission_id for r in got.collect()) == want and 20 < len(want) < len(ids)


def test_reconcile_partitions_the_ids(spark):
    left = spark.createDataFrame([(i,) for i in "aabcx"], "id string")
    right = spark.createDataFrame([(i,) for i in "bddd"], "id string")
    got = {(r.id, r.side, r.copies) for r in reconcile.reconcile(left, right, "id").collect()}
    assert got == {("a", "left", 2), ("c", "left", 1), ("x", "left", 1), ("d", "right", 3)}
    assert sorted(r.id for r in reconcile.missing_rows(left, right, "id").collect()) == ["a", "a", "c", "x"]
    assert sorted(r.id for r in reconcile.missing_ids(left, right, "id").collect()) == ["a", "c", "x"]
    assert sorted(r.id for r in sets.difference(left, right, "id").collect()) == ["a", "c", "x"]


def test_upsert_and_append(spark):
    old = spark.createDataFrame([("1", "2018-01-01", "x"), ("2", "2018-01-01", "y")], "identifier string, datestamp string, t string")
    new = spark.createDataFrame([("1", "2018-02-01")], "identifier string, datestamp string")
    both = sets.append_records(old, new)
    assert both.count() == 3 and both.filter("t IS NULL").count() == 1
    kept = {r.identifier: r.t for r in sets.upsert(old, new, recency=["datestamp"]).collect()}
    assert kept == {"1": None, "2": "y"}


def test_source_tier_and_outcome(spark):
    keys = spark.createDataFrame([("src/a.tar",), ("src/b.tar",), ("src/c.tar",)], "path string")
    local = spark.createDataFrame([("/disk/a.tar",)], "path string")
    mirror = spark.createDataFrame([("1", "a.tar"), ("2", "b.tar"), ("3", "b.tar")], "id string, title string")
    got = {r.path: (r.tier, r.mirror_id) for r in reconcile.source_tier(keys, local, mirror).collect()}
    assert got == {"src/a.tar": ("local", "1"), "src/b.tar": ("mirror", "3"), "src/c.tar": ("origin", None)}
