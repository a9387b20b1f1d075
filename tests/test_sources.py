import datetime
import gzip
import io
import json
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from paperloom.operators import aggregates, reconcile, topk
from paperloom.sources import archives, files, sinks, tables, xml_records

PAGE = """<?xml version="1.0" encoding="UTF-8"?>
<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><responseDate>2018-06-09T00:00:00Z</responseDate>
<ListRecords>
<record><header><identifier>oai:1</identifier><datestamp>2018-01-01</datestamp><setSpec>physics:a</setSpec></header>
<metadata><paper xmlns="http://example.org/paper/"><id>astro-ph/0001001</id><created>2000-01-01</created>
<updated>2001-01-01</updated><updated>2002-01-01</updated>
<authors><author><keyname>Doe</keyname><forenames> A.</forenames></author><author><keyname>Collab</keyname></author>
<author><keyname>X</keyname><forenames></forenames></author></authors>
<title>  A title
 of two lines</title><categories>astro-ph.GA hep-th</categories><comments>3 pages</comments>
<abstract> Some text </abstract></paper></metadata></record>
<record><header><identifier>oai:2</identifier><datestamp>2018-01-02</datestamp><setSpec>physics:a</setSpec></header>
<metadata><paper xmlns="http://example.org/paper/"><id>0704.0009</id><title>T</title><doi>10.1/2</doi>
<journal-ref>J</journal-ref></paper></metadata></record>
{token}
</ListRecords></OAI-PMH>"""


def write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as out:
        out.write(text)
    return str(path)


def test_harvest_page(spark, tmp_path):
    folder = str(tmp_path / "pages")
    write(f"{folder}/p1.xml", PAGE.format(
        token='<resumptionToken cursor="0" completeListSize="4">abc</resumptionToken>'))
    write(f"{folder}/p2.xml", PAGE.format(token=""))
    rows = {(r.identifier): r for r in xml_records.read_records(spark, f"{folder}/p1.xml").collect()}
    first, second = rows["oai:1"], rows["oai:2"]
    assert first.authors == "A. Doe,  X"
    assert first.updated == "2001-01-01"
    assert first.title == "  A title\n of two lines"
    assert first.filename_parsed == "astro-ph0001001" and first.comments == "3 pages"
    assert first.doi is None and first.journal is None and first.abstract == " Some text "
    assert second.authors == "" and second.doi == "10.1/2" and second.journal == "J"
    assert second.filename_parsed == "0704.0009" and second.date_retrieved is not None
    marks = xml_records.read_harvest_tokens(spark, folder)
    assert [(m.cursor, m.complete_list_size, m.token) for m in marks.collect()] == [(0, 4, "abc")]
    progress = aggregates.harvest_progress(xml_records.read_records(spark, folder), marks).first()
    assert (progress.obtained, progress.announced, progress.complete) == (4, 4, True)
    dates = xml_records.read_response_dates(spark, folder).select("response_date").distinct().collect()
    assert [d[0] for d in dates] == ["2018-06-09T00:00:00Z"]


def test_sets(spark, tmp_path):
    path = write(str(tmp_path / "s" / "sets.xml"),
                 "<OAI-PMH><ListSets><set><setSpec>cs</setSpec><setName>c</setName></set>"
                 "<set><setSpec>math</setSpec></set></ListSets></OAI-PMH>")
    assert {r[0] for r in xml_records.read_sets(spark, path).collect()} == {"cs", "math"}


def test_feed(spark, tmp_path):
    path = write(str(tmp_path / "f" / "feed.xml"), """<feed xmlns="http://www.w3.org/2005/Atom">
<entry><id>http://x/1</id><updated>u</updated><published>p</published><title>T</title><summary>S</summary>
<author><name>A B</name></author><author><name>C D</name></author>
<ext:doi xmlns:ext="http://example.org/schemas/atom">10.1/1</ext:doi>
<link title="doi" href="http://doi/1" rel="related"/><link href="http://abs/1" rel="alternate"/>
<link title="pdf" href="http://pdf/old"/><link title="pdf" href="http://pdf/1"/>
<ext:comment xmlns:ext="http://example.org/schemas/atom">5 pages</ext:comment>
<ext:primary_category xmlns:ext="http://example.org/schemas/atom" term="astro-ph.GA" scheme="s"/></entry>
<entry><id>http://x/2</id><title>U</title><author><name>E</name></author></entry></feed>""")
    one, two = sorted(xml_records.read_feed(spark, path).collect(), key=lambda r: r.id)
    assert one.authors == "A B, C D" and one.doi == "10.1/1" and one.doi_link == "http://doi/1"
    assert one.pdf_link == "http://pdf/1" and one.category == "astro-ph.GA" and one.comment == "5 pages"
    assert one.journal is None
    assert (two.doi, two.doi_link, two.pdf_link, two.category) == (None,) * 4


def test_manifest(spark, tmp_path):
    path = write(str(tmp_path / "m" / "manifest.xml"), """<?xml version="1.0"?>
<manifest><timestamp>Sat Jun 9 2018</timestamp>
<file><filename>a.tar</filename><size>512000001</size><timestamp>2018-01-02 03:04:05</timestamp><yymm>1801</yymm></file>
<file><filename>b.tar</filename><size>100</size><timestamp>2010-05-06 00:00:00</timestamp><yymm>0001</yymm></file>
</manifest>""")
    raw = xml_records.read_manifest(spark, path)
    by_name = {r.filename: r for r in raw.collect()}
    assert by_name["a.tar"].md5sum == "" and by_name["b.tar"].yymm == "0001"
    assert xml_records.read_manifest_header(spark, path).first()[0] == "Sat Jun 9 2018"
    typed = xml_records.typed_manifest(raw)
    assert tuple(aggregates.size_totals(typed).first()) == (2, 0.51)
    assert tuple(aggregates.year_totals(typed, "18").first()) == (1, 0.512000001)
    assert tuple(aggregates.oversize_totals(typed).first()) == (1, 512.0)
    assert tuple(aggregates.time_range(typed).first()) == ("05/06/2010", "01/02/2018")
    nulls = {r.column_name: r.nulls for r in aggregates.null_profile(raw).collect()}
    assert nulls["md5sum"] == 0 and len(nulls) == 10


def test_records_csv_keeps_ids_and_newlines(spark, tmp_path):
    path = write(str(tmp_path / "r" / "records.csv"), 'abstract,filename,date_retrieved,filename_parsed\n'
                 '"two\nlines, ""quoted""",0001,2018-06-09 01:02:03.5,0001\n')
    row = tables.read_records_csv(spark, path).first()
    assert row.filename == "0001" and row.abstract == 'two\nlines, "quoted"' and row.doi is None
    assert row.date_retrieved == datetime.datetime(2018, 6, 9, 1, 2, 3, 500000)
    out = str(tmp_path / "back")
    sinks.write_records(tables.read_records_csv(spark, path), out, "csv")
    assert tables.read_records_csv(spark, out).first().abstract == row.abstract
    assert [r[0] for r in tables.read_identifiers(spark, out).collect()] == ["0001"]


def test_records_csv_of_several_column_orders(spark, tmp_path):
    folder = tmp_path / "orders"
    write(str(folder / "a.csv"), "identifier,filename,abstract\ni1,f1,x\n")
    write(str(folder / "b.csv"), 'filename,identifier\nf2,i2\n"f\n3",i3\n')
    rows = {r.identifier: (r.filename, r.abstract) for r in tables.read_records_csv(spark, str(folder)).collect()}
    assert rows == {"i1": ("f1", "x"), "i2": ("f2", None), "i3": ("f\n3", None)}


def test_words_of_a_table_are_removed(spark):
    from paperloom.operators.filters import without_words

    tokens = spark.createDataFrame([(1, ["a", "b", "a", "c"]), (2, ["b"]), (3, []), (4, None), (5, ["d", "d"])], "doc_id int, tokens array<string>")
    listed = spark.createDataFrame([("a",), ("b",), ("a",)], "word string")
    got = {r.doc_id: r.tokens for r in without_words(tokens, listed).collect()}
    assert got == {1: ["c"], 2: [], 3: [], 4: None, 5: ["d", "d"]}


def test_failed_archives_are_reported_and_tried_again(spark, tmp_path):
    from paperloom.streaming import incremental

    landing, table = tmp_path / "landing", str(tmp_path / "table")
    good = io.BytesIO()
    with tarfile.open(fileobj=good, mode="w") as tar:
        data = gzip.compress(b"text")
        info = tarfile.TarInfo("0704.0009.gz")
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))
    write(str(landing / "a.tar"), good.getvalue(), "wb")
    write(str(landing / "b.tar"), b"junk", "wb")
    write(str(landing / "c.tar"), good.getvalue()[:600], "wb")
    ids = spark.createDataFrame([("0704.0009",)], "filename_parsed string")
    inner = archives.explode_archives(files.read_archives(spark, str(landing)), ids)
    assert {(r.tar_name, r.kind) for r in inner.collect()} >= {("a.tar", "file"), ("b.tar", "not_tar")}
    incremental.ingest_archives(spark, str(landing), ids, table, str(tmp_path / "checkpoint"))
    failed = {r.tar_name for r in incremental.failed_archives(spark, table).collect()}
    assert failed == {"b.tar", "c.tar"}
    write(str(landing / "b.tar"), good.getvalue(), "wb")
    incremental.retry_archives(spark, str(landing), ids, table)
    assert {r.tar_name for r in incremental.failed_archives(spark, table).collect()} == {"c.tar"}


def test_citations_are_resolved_in_the_row(spark):
    from paperloom.operators import markup
    from paperloom.queries.markup import papers
    from paperloom.queries.registry import Tables

    parsed = markup.parse_documents(papers(Tables(spark, "/root/testdata/sf0.001")))
    plan = markup.citation_counts(parsed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Join" not in plan


def test_small_tables(spark, tmp_path):
    words = write(str(tmp_path / "w" / "stop.json"), json.dumps(["the", "a", "the"]))
    assert tables.load_stopwords(spark, words) == ["a", "the"]
    layout = write(str(tmp_path / "l" / "layout.txt"), "2 2\n1.5 -2e-3\n0 4\n")
    assert [tuple(r) for r in tables.read_layout(spark, layout).collect()] == [(1.5, -0.002), (0.0, 4.0)]
    subjects = write(str(tmp_path / "s" / "s.csv"), "length,id,main,categories\n10,0704.0009,astro-ph,astro-ph x\n")
    assert tuple(tables.read_subjects(spark, subjects).first()) == (10, "0704.0009", "astro-ph", "astro-ph x")
    matrix = write(str(tmp_path / "m" / "c.mm"), "%%MatrixMarket matrix coordinate real general\n2 3 2\n1 1 4\n2 3 1\n")
    assert sorted(map(tuple, tables.read_matrix_market(spark, matrix).collect())) == [(0, 0, 4), (1, 2, 1)]


def test_text_files_and_listings(spark, tmp_path):
    root = str(tmp_path / "t")
    write(f"{root}/0704.0009.txt", "line one\nline two")
    write(f"{root}/sub/x.txt", "b")
    write(f"{root}/y.tar", "c")
    docs = {r.doc_id: r.text for r in files.read_documents(spark, root).collect()}
    assert docs == {"0704.0009": "line one\nline two", "x": "b"}
    assert files.list_objects(spark, root).count() == 1
    assert "content" not in files.list_objects(spark, root).columns
    assert {r[0] for r in files.output_inventory(spark, root, ".txt").collect()} == {"0704.0009", "x"}
    assert files.read_line_corpus(spark, f"{root}/0704.0009.txt").count() == 2
    write(f"{root}/p.xml", "<a/>")
    assert tuple(files.read_markup(spark, root).first()) == ("p", "<a/>")


def test_submission_log_across_splits(spark, tmp_path):
    """A log far larger than a split is filled by many tasks and stays exact."""
    lines, want, tar = ["orphan"], [(None, "orphan")], None
    for i in range(3000):
        if i % 700 == 0:
            tar = f"a.b{i}"
            lines.append(f"TARFILE: {tar}.tar")
        lines.append(f"id{i}")
        want.append((tar, f"id{i}"))
        if i % 50 == 0:
            lines.append("")
    path = write(str(tmp_path / "logs" / "l.txt"), "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        assert files.read_log_lines(spark, path).select("block").distinct().count() > 5
        got = [tuple(r) for r in files.read_submission_log(spark, path).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got, key=str) == sorted(want, key=str)
    log = spark.createDataFrame(got, "tarfile string, submission_id string")
    outputs = log.filter("tarfile <> 'a.b700'").select("submission_id")
    assert [r[0] for r in reconcile.restart_archives(log, outputs).collect()] == ["a.b700"]


def test_submission_tree_and_main_files(spark, tmp_path):
    root = str(tmp_path / "latex")
    write(f"{root}/t1/one/only.tex", "text")
    write(f"{root}/t1/two/a.tex", r"\documentclass{a}")
    write(f"{root}/t1/two/deep/ms.tex", "x")
    write(f"{root}/t1/three/b.tex", "%\\documentstyle{x}")
    write(f"{root}/t1/three/c.tex", "y\n\\documentstyle{x}")
    write(f"{root}/t1/four/b.tex", "no")
    write(f"{root}/t1/four/c.tex", "no")
    write(f"{root}/t1/loose.tex", "skipped")
    tree = files.read_submission_tree(spark, root)
    assert tree.count() == 7
    main = {r.submission_id: r.main_path for r in topk.main_files(tree).collect()}
    assert main == {"one": "only.tex", "two": "deep/ms.tex", "three": "b.tex", "four": None}
    strict = {r.submission_id: r.main_path for r in topk.main_files(tree, strict=True).collect()}
    assert strict["three"] == "c.tex"
    subs = spark.createDataFrame([(s,) for s in ("one", "two", "three", "four", "five")], "submission_id string")
    counters = topk.submission_counters(topk.submission_status(topk.main_files(tree), subs)).first()
    assert tuple(counters) == (7, 5, 3, 1, 1)
    assert [r[0] for r in reconcile.empty_submissions(subs, tree).collect()] == ["five"]


def tar_bytes(items, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as tar:
        for name, data in items:
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
                tar.addfile(info)
            else:
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
    return out.getvalue()


@pytest.fixture
def archive_dir(tmp_path):
    nested = tar_bytes([("deep.tex", b"deep")], "w:gz")
    good = tar_bytes([("figs", None), ("main.tex", b"M"), ("figs/f.eps", b"E"), ("more.tar.gz", nested)], "w:gz")
    whole = tar_bytes([
        ("d", None), ("d/0704.0009.gz", good), ("d/astro-ph0001001.gz", gzip.compress(b"plain")),
        ("d/0704.0010.pdf", b"%PDF"), ("d/9999.gz", good), ("d/0704.0011.gz", b"broken"), ("d/readme.txt", b"r"),
    ])
    root = str(tmp_path / "src")
    write(f"{root}/s1.tar", whole, "wb")
    write(f"{root}/empty.tar", tar_bytes([]), "wb")
    write(f"{root}/fake.tar", b"this is no archive", "wb")
    return root


def test_archives(spark, archive_dir):
    source = files.read_archives(spark, archive_dir)
    members = archives.tar_members(source)
    kinds = {(r.tar_name, r.submission_id): r.kind for r in members.collect()}
    assert kinds[("s1.tar", "0704.0010")] == "pdf" and kinds[("fake.tar", None)] == "not_tar"
    assert len(kinds) == 6
    assert [tuple(r) for r in archives.pdf_only(members).collect()] == [("s1.tar", "0704.0010")]
    ids = spark.createDataFrame([("0704.0009",), ("astro-ph0001001",), ("0704.0011",)], "filename_parsed string")
    inner = archives.explode_archives(source, ids)
    got = {(r.submission_id, r.inner_path, r.kind): r.content for r in inner.collect()}
    assert got[("0704.0009", "main.tex", "file")] == b"M"
    assert got[("astro-ph0001001", "astro-ph0001001.tex", "file")] == b"plain"
    assert ("0704.0011", None, "error") in got and not any(k[0] == "9999" for k in got)
    assert not any(k[1] == "figs" for k in got)
    tex = archives.tex_files(inner).filter("kind = 'file'")
    assert {r.inner_path for r in tex.collect()} == {"main.tex", "astro-ph0001001.tex"}
    deep = archives.explode_archives(source, ids, recursive=True)
    assert "more.tar.gz/deep.tex" in {r.inner_path for r in deep.collect()}
    named = archives.explode_archives(source, name_part="astro-ph")
    assert {(r.submission_id, r.kind) for r in named.collect()} == {("astro-ph0001001", "file"), (None, "not_tar")}
    counters = archives.extraction_counters(members, archives.inner_files(members)).first()
    assert (counters.matched, counters.extracted) == (4, 3)


def test_snapshot_and_vector_lines(spark, tmp_path):
    root = str(tmp_path / "snap")
    assert sinks.current_version(spark, root) is None
    sinks.write_snapshot(spark.range(3), root)
    sinks.write_snapshot(sinks.read_snapshot(spark, root).union(spark.range(2)), root)
    assert sinks.current_version(spark, root) == 2 and sinks.read_snapshot(spark, root).count() == 5
    vectors = spark.createDataFrame([("b", [1.0, 2.0]), ("a", [0.5, -1.0])], "doc_id string, vector array<double>")
    out = str(tmp_path / "tsv")
    sinks.write_vectors_tsv(vectors, out, order="doc_id")
    text = "".join(open(f"{out}/{part}/{n}").read() for part in ("header", "body")
                   for n in sorted(os.listdir(f"{out}/{part}")) if n.startswith("part"))
    assert text == "2\t2\n0.5\t-1.0\n1.0\t2.0\n"


def test_mirror_inventory(spark):
    rows = [("f", "arch", "root", "folder", False), ("1", "b.tar", "f", "x", False), ("2", "a.tar", "f", "x", False),
            ("3", "c.tar", "f", "x", True), ("4", "d.tar", "other", "x", False)]
    table = spark.createDataFrame(rows, "id string, title string, parent_id string, mime_type string, trashed boolean")
    listed = files.mirror_inventory(table, "arch", folder_mime="folder")
    assert [r.title for r in topk.sort_by_title(listed).collect()] == ["a.tar", "b.tar"]
    assert F is not None
