"""The tree of submissions is written and read by many tasks, whatever the sizes of its files."""

import hashlib
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paperloom.sources import files


def test_tree_is_written_by_many_tasks(spark, tmp_path):
    rows = [(k, f"name {k}", k % 3) for k in range(64)] + [(64, None, 1), (65, "no nation", None)]
    spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    found = {(r.archive, r.submission_id): r.digest for r in entry.queries()["submission_tree"](spark, str(tmp_path)).collect()}
    assert len(found) == 66 and ("n=__HIVE_DEFAULT_PARTITION__", "s=65") in found
    assert found["n=2", "s=5"] == hashlib.md5(b"name 5\n").hexdigest() and found["n=1", "s=64"] == hashlib.md5(b"\n").hexdigest()
    root = urlparse(spark.sparkContext.getCheckpointDir()).path
    lists = [p for p in Path(root).glob("tree-*/_written/*/*") if p.name != "job" and "lines.txt" in p.read_text()]
    assert len(lists) > 2


def test_names_of_files_stay_in_tasks(spark, tmp_path):
    """Files are found by tasks, by the rules of Spark's own scans."""
    root = tmp_path / "tree"
    kept = {"n=1/s=1/ms.tex": b"one", "n=1/s=1/figs/deep/a.tex": b"deep", "n=1/s=2/a b%20c.tex": b"\xff\x00", "_x=1/_y=2/b.tex": b"two"}
    left = ["n=1/lies.tex", "n=1/s=1/void.tex", "n=1/s=1/ms.log", "_written/job/a.tex", "n=1/.s/a.tex", "n=1/s=1/_a.tex", "n=1/s=1/.b.tex", "n=1/s=1/c.tex._COPYING_"]
    for name, content in [*kept.items(), *((n, b"" if "void" in n else b"no") for n in left)]:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    (root / "empty/none").mkdir(parents=True)
    for place in (f"{root}", f"{root}/", f"file://{root}", f"file:{root}"):
        tree = files.read_submission_tree(spark, place)
        assert tree.inputFiles() == []  # which the driver held
        found = {f"{r.archive}/{r.submission_id}/{r.inner_path}": bytes(r.content) for r in tree.select("archive", "submission_id", "inner_path", F.col("content").cast("binary")).collect()}
        assert found == kept
    plain = files._tree_of_spark(spark, f"{root}", ".tex")
    assert {f"{r.archive}/{r.submission_id}/{r.inner_path}" for r in plain.select("archive", "submission_id", "inner_path").collect()} == kept.keys()
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_submission_tree(spark, f"{root}/absent")
