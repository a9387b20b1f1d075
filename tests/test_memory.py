"""What a Python worker holds at a time, and to how many tasks short rows that name long work are dealt."""

import io
import tarfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from paperloom.operators import similarity as S
from paperloom.queries.registry import Tables
from paperloom.sources import ranges as R

ROWS, BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def wide(spark):
    """Batches as a session has them that names no bounds."""
    held = {k: spark.conf.get(k) for k in (ROWS, BYTES)}
    spark.conf.set(ROWS, "10000")
    spark.conf.set(BYTES, str(1 << 30))
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def test_queries_bound_batches_of_any_session(spark, tmp_path, wide):
    spark.range(5000).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    table = Tables(spark, str(tmp_path)).t

    def sizes_of(frames):
        for frame in frames:
            yield pd.DataFrame({"n": [len(frame)]})

    sizes = [r.n for r in table.mapInPandas(sizes_of, "n long").collect()]
    assert sum(sizes) == 5000 and max(sizes) <= 1000


def test_nearest_exact_over_slices(spark, wide, monkeypatch):
    """More rows than a slice, in one batch; equal rows lie on both sides of a slice's end."""
    assert S.SLICE <= 1000
    rows = [(i, [float(i % 7 + 1), float(i % 3), 1.0]) for i in range(2100)]
    table = spark.createDataFrame(rows, "doc_id long, vector array<double>").coalesce(1)
    found = {(r.doc_id, r["rank"]): r.neighbour for r in S.nearest_exact(table.filter("doc_id in (0, 998)"), table, 5).collect()}
    for asked in (0, 998):
        same = [i for i in range(2100) if i != asked and i % 21 == asked % 21][:5]
        assert [found[asked, k] for k in range(1, 6)] == same


def test_archives_are_dealt_to_many_tasks(spark, tmp_path):
    for k in range(16):
        with tarfile.open(f"{tmp_path}/{k}.tar", "w") as tar:
            for name in ("a.gz", "b.gz"):
                info = tarfile.TarInfo(f"{k}/{name}")
                info.size = 4
                tar.addfile(info, io.BytesIO(b"text"))
    listing = spark.createDataFrame([(f"{tmp_path}/{k}.tar",) for k in range(16)], "path string")
    index = R.index_archives(listing).withColumn("task", F.spark_partition_id()).cache()
    assert index.count() == 32 and index.select("task").distinct().count() > 2
    read = R.read_ranges(R.member_ranges(index, 1024)).withColumn("task", F.spark_partition_id()).collect()
    assert len(read) == 32 and len({r.task for r in read}) > 2
