"""CSV read by many tasks against the serial reader."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.sources import csv_splits, tables

FIELD = st.text(alphabet=st.sampled_from('ab ,"\n\r;\'é'), max_size=12)


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def rows(frame):
    return sorted(tuple(r) for r in frame.select("identifier", "title", "abstract").collect())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(FIELD, FIELD, st.booleans()), min_size=1, max_size=12), st.booleans())
def test_splits_read_what_one_task_reads(spark, tmp_path_factory, small_splits, fields, windows):
    end = "\r\n" if windows else "\n"
    lines = ["identifier,title,abstract"]
    for k, (a, b, bare) in enumerate(fields):
        plain = bare and not set(a) & set('",\n\r') and a.strip() == a
        lines.append(f"i{k},{a if plain else quoted(a)},{quoted(b)}")
    path = tmp_path_factory.mktemp("csv")
    (path / "r.csv").write_bytes(end.join(lines).encode() + (end.encode() if len(fields) % 2 else b""))
    got = rows(tables.read_records_csv(spark, str(path)))
    want = sorted((f"i{k}", a, b) for k, (a, b, _) in enumerate(fields))
    assert [tuple(x or "" for x in r) for r in got] == want
    if "\r" not in "".join(a + b for a, b, _ in fields):
        assert got == rows(tables.read_records_csv(spark, str(path), split=False))


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    rng = random.Random(4)
    fields = [(f"i{k}", "".join(rng.choice('xy,"\n') for _ in range(rng.randrange(0, 400)))) for k in range(150)]
    (tmp_path / "r.csv").write_text("abstract,identifier\n" + "".join(f"{quoted(t)},{i}\n" for i, t in fields))
    (tmp_path / "s.csv").write_text("identifier,title\nj1,plain\n")
    pieces = csv_splits.csv_pieces(spark, str(tmp_path))
    assert pieces.select(F.spark_partition_id()).distinct().count() > 50
    kinds = {r.kind for r in pieces.select("kind").distinct().collect()}
    assert kinds == {"header", "record", "tail", "middle", "head"}
    got = {r.identifier: (r.title, r.abstract or "") for r in tables.read_records_csv(spark, str(tmp_path)).collect()}
    assert got == {**{i: (None, t) for i, t in fields}, "j1": ("plain", "")}


def test_empty_folder_files_and_open_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("identifier,title\n")
    assert tables.read_records_csv(spark, str(tmp_path)).count() == 0
    (tmp_path / "c.csv").write_text('identifier,title\n\ni1,"never\nclosed')
    got = tables.read_records_csv(spark, str(tmp_path)).collect()
    assert [(r.identifier, r.title) for r in got] == [("i1", "never\nclosed")]
