"""Extracted files written one by one, below `root/<archive>/<submission>/`, as tasks commit them.

A task writes into a folder of its own attempt.  Once all its files are there it moves them to their places and leaves a
list of them; the driver gets that list's name and two counts.  So
* a task that fails, or an executor that is lost, leaves nothing in the tree: its attempt's folder goes when it fails, at
  the latest when the job ends;
* a task that runs again writes the same files over its own;
* a job that fails removes what its committed tasks have put there, by their lists;
* a job that succeeds leaves one record of itself, `_written/<job>`, with the lists and the counts.
"""

from __future__ import annotations

import contextlib
import json
import os
import posixpath
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from paperloom.functions.paths import stem
from paperloom.sources.storage import file_system, inside

FORMAT = "submission_files"
_SCHEMA = "archive string, submission_id string, inner_path string, content binary"


@dataclass
class TaskWritten(WriterCommitMessage):
    """What a committed task tells the driver."""

    listing: str
    files: int
    bytes: int


class SubmissionFiles(DataSource):
    """`df.write.format("submission_files").mode("append").save(root)` for (archive, submission_id, inner_path, content)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return _SCHEMA

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("submission files are added to a tree, not written over it: use mode append")
        return _Writer(self.options["path"])


class _Writer(DataSourceWriter):
    def __init__(self, root: str):
        self.root, self.job = root.rstrip("/"), uuid.uuid4().hex

    def write(self, rows):
        system, root = file_system(self.root)
        attempt = f"{root}/_attempts/{self.job}/{uuid.uuid4().hex}"
        names, total = {}, 0
        try:
            system.create_dir(attempt, recursive=True)
            for row in rows:
                place = inside(row.archive, row.submission_id, row.inner_path)
                if place is None or len(place.split("/")) < 3:
                    raise ValueError(f"a file's place lies outside its submission: {row.archive}/{row.submission_id}/{row.inner_path}")
                with system.open_output_stream(f"{attempt}/{len(names)}") as out:
                    out.write(row.content or b"")
                names[place] = f"{attempt}/{len(names)}"
                total += len(row.content or b"")
            listing = f"{root}/_written/{self.job}/{uuid.uuid4().hex}"
            system.create_dir(posixpath.dirname(listing), recursive=True)
            with system.open_output_stream(listing) as out:
                out.write("\n".join(map(json.dumps, names)).encode())
            for folder in sorted({posixpath.dirname(p) for p in names}):
                system.create_dir(f"{root}/{folder}", recursive=True)
            for place, own in names.items():
                system.move(own, f"{root}/{place}")
        finally:
            with contextlib.suppress(OSError):
                system.delete_dir(attempt)
        return TaskWritten(listing, len(names), total)

    def commit(self, messages):
        system, root = file_system(self.root)
        done = [m for m in messages if m is not None]
        record = {"files": sum(m.files for m in done), "bytes": sum(m.bytes for m in done), "lists": [os.path.basename(m.listing) for m in done]}
        system.create_dir(f"{root}/_written/{self.job}", recursive=True)
        with system.open_output_stream(f"{root}/_written/{self.job}/job") as out:
            out.write(json.dumps(record).encode())
        self._clear(system, f"{root}/_attempts/{self.job}")

    def abort(self, messages):
        system, root = file_system(self.root)
        # Lists are there before files are moved, so those of tasks whose message was lost are found as well.
        from pyarrow import fs

        for info in system.get_file_info(fs.FileSelector(f"{root}/_written/{self.job}", allow_not_found=True)):
            with system.open_input_stream(info.path) as listed:
                for place in listed.read().decode().splitlines():
                    with contextlib.suppress(OSError):
                        system.delete_file(f"{root}/{json.loads(place)}")
        self._clear(system, f"{root}/_written/{self.job}")
        self._clear(system, f"{root}/_attempts/{self.job}")

    @staticmethod
    def _clear(system, folder):
        with contextlib.suppress(OSError):
            system.delete_dir(folder)


def write_submission_files(files: DataFrame, root: str) -> None:
    """Write extracted files (tar_name, submission_id, inner_path, content, kind) below `root/<archive>/<submission>/`.

    A submission's files meet in one task, so that it appears as a whole; archives are spread.
    """
    files.sparkSession.dataSource.register(SubmissionFiles)
    kept = files.filter(F.col("kind") == "file").select(
        stem("tar_name").alias("archive"), "submission_id", "inner_path", "content")
    kept.repartition("archive", "submission_id").write.format(FORMAT).mode("append").save(root)
