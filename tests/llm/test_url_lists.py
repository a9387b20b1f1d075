import datetime
import random

from pyspark.sql import functions as F

from paperloom.llm import url_lists
from paperloom.llm.queries import OP5_SQL, op5_url_lists
from tests.oracle import compare, connect

DAY = datetime.date(2024, 1, 1)
EVENTS = "list string, pattern string, action string, day date"


def day(n):
    return DAY + datetime.timedelta(days=n)


def test_intervals(spark):
    rows = [("a", "x", "add", day(1)), ("a", "x", "remove", day(5)), ("a", "x", "add", day(9)), ("a", "x", "add", day(9)), ("b", "x", "add", day(3)),
            ("b", "x", "add", day(4)), ("c", "x", "add", day(2)), ("c", "x", "remove", day(2)), ("d", "x", "remove", day(1)),
            (None, "x", "add", day(1)), ("a", None, "add", day(1)), ("a", "x", None, day(1)), ("a", "x", "add", None), ("a", "x", "other", day(1))]
    got = sorted(map(tuple, url_lists.validity_intervals(spark.createDataFrame(rows, EVENTS)).collect()), key=str)
    assert got == sorted([("a", "x", day(1), day(5)), ("a", "x", day(9), None), ("b", "x", day(3), day(4)), ("b", "x", day(4), None)], key=str)


def test_keys(spark):
    urls = [("https://u:p@A.b.co:8/x//y?q#f",), ("http://h",), ("no url",), (None,), ("",)]
    frame = spark.createDataFrame(urls, "url string")
    got = [r.k for r in frame.select(url_lists.url_keys(F.col("url")).alias("k")).collect()]
    assert got == [["a.b.co", "b.co", "co", "a.b.co/x", "a.b.co/x/y"], ["h"], None, None, None]


def test_against_plain_loops(spark):
    rng = random.Random(6)
    hosts = [f"{s}{d}" for s in ("", "m.", "blog.") for d in ("a.org", "b.com", "c.net")]
    events = [(rng.choice(["l1", "l2"]), rng.choice([*hosts, "org", "a.org/en", "b.com/en/x"]), rng.choice(["add", "remove"]), day(rng.randrange(400))) for _ in range(120)]
    captures = [(k, f"https://{rng.choice(hosts)}/{rng.choice(['en', 'en/x', 'de', ''])}", day(rng.randrange(-10, 500))) for k in range(300)]
    captures += [(900, None, day(3)), (901, "http://a.org", None), (902, *captures[0][1:]), (902, *captures[0][1:])]
    intervals = url_lists.validity_intervals(spark.createDataFrame(events, EVENTS))
    frame = spark.createDataFrame(captures, "id long, url string, fetched date").withColumn("blocked", F.lit("clash")).withColumn("pattern", F.lit(1))
    got = sorted(((r.id, r.blocked, r.n_entries, r.list, r.pattern, r.listed_since) for r in url_lists.evaluate(frame, intervals).collect()), key=str)
    want = []
    for k, url, fetched in captures:
        active = {}
        if url and fetched:
            host, _, path = url.split("//")[1].partition("/")
            parts = [p for p in path.split("/") if p]
            keys = {host.split(".", i)[-1] for i in range(host.count(".") + 1)} | {"/".join([host, *parts[:i]]) for i in range(1, len(parts) + 1)}
            for name, pattern in {(e[0], e[1]) for e in events if e[1] in keys}:
                past = sorted((e[3], e[2]) for e in events if e[:2] == (name, pattern) and e[3] <= fetched)
                if past and past[-1][1] == "add":
                    active[-len(pattern), name, pattern] = past[-1][0]
        best = min(active, default=None)
        want.append((k, bool(active), len(active), *((best[1], best[2], active[best]) if best else (None, None, None))))
    assert got == sorted(want, key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], EVENTS)
    captures = spark.createDataFrame([(1, "http://a.org", DAY)], "id long, url string, fetched date")
    assert [r.blocked for r in url_lists.evaluate(captures, url_lists.validity_intervals(none)).collect()] == [False]
    assert url_lists.evaluate(captures.where("false"), url_lists.validity_intervals(none)).count() == 0


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(op5_url_lists(spark, folder), connect(folder), OP5_SQL) is None
