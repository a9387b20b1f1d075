"""Archives read by ranges, files written by tasks, and the landing stream."""

import gzip
import io
import os
import tarfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from paperloom.sources import archives as A, files, ranges as R, submission_files as W
from paperloom.streaming import landing as L


def tar(path, members, fmt=tarfile.PAX_FORMAT, cut=None):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=fmt) as archive:
        folder = tarfile.TarInfo("d")
        folder.type = tarfile.DIRTYPE
        archive.addfile(folder)
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(out.getvalue()[:cut])


def members(n, seed=0):
    return [(f"d/{'é' * (k % 3) + 'x' * (130 * (k % 5 == 0))}{seed}{k}" + (".pdf" if k % 7 == 3 else ".gz"),
             gzip.compress(os.urandom(300 + 97 * (k % 11)))) for k in range(n)]


@pytest.mark.parametrize("fmt", [tarfile.PAX_FORMAT, tarfile.GNU_FORMAT, tarfile.USTAR_FORMAT])
def test_ranges_hold_what_the_whole_archive_holds(spark, tmp_path, fmt):
    folder = str(tmp_path / "in")
    own = [(n.replace("é", "e") if fmt == tarfile.USTAR_FORMAT else n, d) for n, d in members(300)]
    tar(f"{folder}/one.tar", [(n[-90:] if fmt == tarfile.USTAR_FORMAT else n, d) for n, d in own], fmt)
    tar(f"{folder}/deep/empty.tar", [], fmt)
    listing = files.list_objects(spark, folder)
    want = A.tar_members(files.read_archives(spark, folder))
    for split in (2000, 40_000, 1 << 30):
        got = R.split_members(spark, listing, split_bytes=split)
        assert got.count() == 300 and want.exceptAll(got).count() == got.exceptAll(want).count() == 0


def test_no_task_and_no_row_holds_an_archive(spark, tmp_path):
    folder = str(tmp_path / "in")
    tar(f"{folder}/one.tar", members(400))
    size = os.path.getsize(f"{folder}/one.tar")
    index = R.index_archives(files.list_objects(spark, folder))
    assert "content" not in index.columns
    stretches = R.member_ranges(index, size // 40)
    assert 30 <= stretches.count() <= 41
    assert stretches.agg(F.max(F.col("ending") - F.col("start"))).first()[0] < size / 20
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = R.read_ranges(stretches)
        held = read.groupBy(F.spark_partition_id()).agg(F.sum(F.length("content")).alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(held) > 4 and max(r.n or 0 for r in held) < size / 2


def test_archives_that_break_off(spark, tmp_path):
    folder = str(tmp_path / "in")
    tar(f"{folder}/cut.tar", members(50), cut=20_000)
    tar(f"{folder}/good.tar", members(5))
    with open(f"{folder}/junk.tar", "wb") as file:
        file.write(b"junk" * 400)
    got = R.split_members(spark, files.list_objects(spark, folder), split_bytes=5000)
    kinds = {(r.tar_name, r.kind): r.n for r in got.groupBy("tar_name", "kind").agg(F.count("*").alias("n")).collect()}
    assert kinds[("junk.tar", "not_tar")] == 1 and kinds[("cut.tar", "error")] == 1
    assert kinds[("good.tar", "gz")] == 4 and kinds[("cut.tar", "gz")] > 5
    want = A.tar_members(files.read_archives(spark, folder)).filter("kind = 'gz'").select("tar_name", "member_name", "content")
    assert got.filter("kind = 'gz'").select("tar_name", "member_name", "content").exceptAll(want).count() == 0


FILES = "tar_name string, submission_id string, inner_path string, kind string, content binary"


def tree(root):
    return sorted(os.path.relpath(os.path.join(d, n), root) for d, _, names in os.walk(root) for n in names)


def test_files_are_written_and_found(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = [(f"a{k % 3}.tar", f"s{k}", f"p/{j}.tex", "file", f"{k} {j}".encode()) for k in range(20) for j in range(3)]
    made = spark.createDataFrame(rows + [("a1.tar", "bad", None, "error", None)], FILES)
    W.write_submission_files(made, root)
    W.write_submission_files(made, root)  # a job that runs again writes the same files
    found = {(r.archive, r.submission_id, r.inner_path): r.content for r in files.read_submission_tree(spark, root).collect()}
    assert found == {(t[:-4], s, p): c.decode() for t, s, p, _, c in rows}
    assert os.listdir(f"{root}/_attempts") == [] and len(os.listdir(f"{root}/_written")) == 2


def test_a_task_that_fails_half_way_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = [("a.tar", f"s{k}", "x.tex", "file", b"%d" % k) for k in range(200)]
    made = spark.createDataFrame(rows, FILES).repartition(4).sortWithinPartitions("submission_id")
    bad = made.withColumn("content", F.when(F.col("submission_id") != "s77", F.col("content")).otherwise(
        F.raise_error(F.lit("lost")).cast("binary")))
    with pytest.raises(Exception, match="lost"):
        W.write_submission_files(bad, root)
    assert tree(root) == []
    W.write_submission_files(made, root)
    assert sum(p.startswith("a/") for p in tree(root)) == 200


def test_an_attempt_that_dies_is_not_seen(tmp_path):
    from pyspark.sql import Row

    root = str(tmp_path / "out")
    writer = W._Writer(root)

    def rows(end):
        for k in range(5):
            yield Row(archive="a", submission_id=f"s{k}", inner_path="x.tex", content=b"x")
        if end:
            raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(rows(True))
    assert tree(root) == []
    message = writer.write(rows(False))
    assert (message.files, message.bytes) == (5, 5) and len([p for p in tree(root) if p.startswith("a/")]) == 5
    writer.abort([message, None])
    assert tree(root) == []
    with pytest.raises(ValueError):
        writer.write([Row(archive="a", submission_id="..", inner_path="../x", content=b"")])


def ids(spark, n):
    return spark.createDataFrame([(str(k),) for k in range(n)], "filename_parsed string")


def landed(folder, name, keys, cut=None):
    tar(f"{folder}/{name}.tar", [(f"d/{k}.gz", gzip.compress(b"text %d" % k)) for k in keys], cut=cut)


def found(spark, table):
    return sorted((r.submission_id, r.attempt) for r in L.landed_files(spark, table).filter("kind = 'file'").collect())


def test_a_batch_that_dies_reads_the_same_archives_again(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    landed(landing, "a", range(3))
    seen = []

    def dies(batch_id):
        seen.append(spark.read.parquet(f"{table}/batch={batch_id}").count())
        raise RuntimeError("lost")

    with pytest.raises(StreamingQueryException):
        L.ingest_landed(spark, landing, ids(spark, 9), table, state, before_commit=dies)
    landed(landing, "b", range(3, 6))
    L.ingest_landed(spark, landing, ids(spark, 9), table, state)
    assert seen == [3] and spark.read.parquet(f"{table}/batch=0").count() == 3  # as before, whatever has landed since
    L.ingest_landed(spark, landing, ids(spark, 9), table, state)
    assert found(spark, table) == [(str(k), 1) for k in range(6)]


def test_a_failed_archive_is_a_later_offset_until_its_attempts_are_spent(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    landed(landing, "a", range(20))
    landed(landing, "b", range(20, 40), cut=6000)
    landed(landing, "c", range(40, 60), cut=300)
    L.ingest_landed(spark, landing, None, table, state)
    first = found(spark, table)
    assert len([s for s, _ in first if int(s) < 20]) == 20 and 0 < len([s for s, _ in first if 20 <= int(s) < 40]) < 20
    landed(landing, "b", range(20, 40))
    for _ in range(4):
        L.ingest_landed(spark, landing, None, table, state)
    assert found(spark, table) == sorted([(str(k), 1) for k in range(20)] + [(str(k), 2) for k in range(20, 40)])
    entries = [e for p in sorted(os.listdir(f"{state}/log")) if p.endswith(".json") for e in __import__("json").load(open(f"{state}/log/{p}"))]
    assert sorted((os.path.basename(p), a) for p, _, a in entries) == [("a.tar", 1), ("b.tar", 1), ("b.tar", 2), ("c.tar", 1), ("c.tar", 2), ("c.tar", 3)]
