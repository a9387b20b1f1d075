"""End-to-end flows: ingest, parse, incremental runs and retries."""

import pytest
from pyspark.sql import functions as F
from test_sources import PAGE, archive_dir, write  # noqa: F401

from paperloom.plans import ingest, parse
from paperloom.sources import files, sinks
from paperloom.streaming import incremental as I


def ids(spark):
    return spark.createDataFrame([("0704.0009",), ("astro-ph0001001",), ("0704.0011",)], "filename_parsed string")


def test_refresh_records(spark, tmp_path):
    folder, table = str(tmp_path / "pages"), str(tmp_path / "records")
    write(f"{folder}/p1.xml", PAGE.format(token=""))
    ingest.refresh_records(spark, folder, table)
    ingest.refresh_records(spark, folder, table)
    assert sinks.read_snapshot(spark, table).count() == 4
    ingest.refresh_records(spark, folder, table, once_per_record=True)
    assert sinks.read_snapshot(spark, table).count() == 2
    ingest.refresh_records(spark, folder, table, spec="physics:other")
    assert sinks.read_snapshot(spark, table).count() == 2


def test_ingest_archives(spark, tmp_path, archive_dir):  # noqa: F811
    out = ingest.IngestTables(*[str(tmp_path / n) for n in ("subs", "log", "pdf", "failures")])
    ingest.ingest_archives(files.read_archives(spark, archive_dir), ids(spark), out)
    read = spark.read.parquet
    assert {r.submission_id for r in read(out.submissions).collect()} == {"0704.0009", "astro-ph0001001"}
    assert {(r.tarfile, r.submission_id) for r in read(out.log).collect()} == {
        ("s1.tar", "0704.0009"), ("s1.tar", "astro-ph0001001"), ("s1.tar", "0704.0011")}
    assert [r.submission_id for r in read(out.pdf_only).collect()] == ["0704.0010"]
    assert {r.kind for r in read(out.failures).collect()} == {"error", "not_tar"}
    listing = files.list_objects(spark, archive_dir)
    todo = ingest.archives_to_do(listing, read(out.log))
    assert {r.tarfile for r in todo.collect()} == {"empty.tar", "fake.tar"}
    mirror = spark.createDataFrame([("9", "fake.tar")], "id string, title string")
    tiers = {r.path.rsplit("/", 1)[1]: r.tier for r in ingest.plan_sources(spark, listing, None, mirror).collect()}
    assert tiers == {"s1.tar": "origin", "empty.tar": "origin", "fake.tar": "mirror"}


def test_parse_corpus_skips_what_is_done(spark, tmp_path):
    raw = spark.createDataFrame([("a", "<d><para>One 2</para></d>"), ("b", "<d><para>"), ("c", "<d/>")], "doc_id string, xml string")
    out, failures = str(tmp_path / "tokens"), str(tmp_path / "failures")
    parse.parse_corpus(raw, out, failures)
    got = {r.doc_id: r.tokens for r in spark.read.parquet(out).collect()}
    assert got == {"a": ["one", "<num>"], "c": []}
    assert [r.doc_id for r in spark.read.parquet(failures).collect()] == ["b"]
    more = raw.union(spark.createDataFrame([("d", "<d><section>x</section></d>")], raw.schema))
    parse.parse_corpus(more, out, failures, done=spark.read.parquet(out))
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == ["a", "c", "d"]


def test_harvest_stream_reads_each_page_once(spark, tmp_path):
    pages, table, check = (str(tmp_path / n) for n in ("pages", "table", "check"))
    write(f"{pages}/p1.xml", PAGE.format(token=""))
    I.ingest_records(spark, pages, table, check)
    I.ingest_records(spark, pages, table, check)
    rows = spark.read.parquet(f"{table}/batch=*")
    assert rows.count() == 2
    write(f"{pages}/p2.xml", PAGE.format(token="").replace("2018-01-02", "2018-03-04"))
    I.ingest_records(spark, pages, table, check)
    assert spark.read.parquet(f"{table}/batch=*").count() == 4
    view = {r.identifier: r.datestamp for r in I.latest_view(spark, table).collect()}
    assert view == {"oai:1": "2018-01-01", "oai:2": "2018-03-04"}
    I.compact(spark, table, str(tmp_path / "compact"))
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 2


def test_archive_stream_is_retried_whole(spark, tmp_path, archive_dir):  # noqa: F811
    table, check = str(tmp_path / "table"), str(tmp_path / "check")
    stream = I.archive_stream(spark, archive_dir)
    calls = []

    def fails_half_way(batch, batch_id):
        I.batch_writer(table, lambda b: b.select("path"))(batch, batch_id)
        calls.append(batch_id)
        raise RuntimeError("executor lost")

    with pytest.raises(Exception):
        I.run_available(stream, fails_half_way, check)
    I.run_available(stream, I.batch_writer(table, lambda b: b.select("path")), check)
    assert calls == [0] and spark.read.parquet(f"{table}/batch=*").count() == 3
    files_, check2 = str(tmp_path / "files"), str(tmp_path / "check2")
    I.ingest_archives(spark, archive_dir, ids(spark), files_, check2)
    got = spark.read.parquet(f"{files_}/batch=*")
    assert got.filter("kind = 'file'").select("submission_id").distinct().count() == 2
    failed = got.filter(F.col("kind") == "not_tar")
    assert [r.tar_name for r in failed.collect()] == ["fake.tar"]  # reported, not dropped
    assert got.count() == 5 + failed.count()


def test_two_threads_append_and_both_are_in_the_table(spark, tmp_path):
    from threading import Barrier, Thread

    root, start, versions = str(tmp_path / "table"), Barrier(4), []

    def append(k):
        new = spark.range(k * 10, k * 10 + 10)
        start.wait()
        versions.append(sinks.update_snapshot(spark, root, lambda old: new if old is None else old.unionByName(new)))

    threads = [Thread(target=append, args=(k,)) for k in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(versions) == [1, 2, 3, 4] and sinks.current_version(spark, root) == 4
    assert sorted(r.id for r in sinks.read_snapshot(spark, root).collect()) == list(range(40))
    assert [sinks.read_snapshot(spark, root, v).count() for v in (1, 2, 3)] == [10, 20, 30]


def test_a_stale_writer_publishes_nothing(spark, tmp_path):
    root = str(tmp_path / "table")
    assert sinks.write_snapshot(spark.range(3), root, 0) == 1
    with pytest.raises(sinks.SnapshotConflict):
        sinks.write_snapshot(spark.range(9), root, 0)
    assert sinks.read_snapshot(spark, root).count() == 3
    assert sinks.write_snapshot(spark.range(5), root) == 2  # replaces whatever is there
    assert len([p for p in (tmp_path / "table" / "data").iterdir()]) == 2  # what the stale one wrote is gone
