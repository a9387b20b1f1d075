"""Shared storage as Python tasks see it: paths of Spark as file systems of Arrow."""

from __future__ import annotations

import os
import posixpath
import re


def file_system(path: str):
    """(file system, path in it) of a path as Spark names it; a path without a scheme is a local or mounted one."""
    from pyarrow import fs

    local = re.match(r"file:/*(/.*)", path)
    if local or "://" not in path:
        return fs.LocalFileSystem(), local[1] if local else path
    return fs.FileSystem.from_uri(path)


def files_below(path: str, suffix: str = "") -> list[tuple[str, int, int]]:
    """(path, bytes, modification time in ns) of the files below a folder, in order of their paths."""
    from pyarrow import fs

    system, root = file_system(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    scheme = path[: len(path) - len(root)] if path.endswith(root) else ""
    return sorted((scheme + f.path, f.size, f.mtime_ns or 0) for f in found if f.is_file and f.path.endswith(suffix))


def inside(*parts: str) -> str | None:
    """The parts as one relative path, or None where it would leave the folder it is meant for."""
    path = posixpath.normpath("/".join(p.replace("\\", "/") for p in parts))
    if path.startswith(("/", "../")) or path in ("..", "."):
        return None
    return path


def put_file(path: str, data) -> None:
    """Write a file, whole or not at all; a task that runs again writes the same over it."""
    system, place = file_system(path)
    system.create_dir(posixpath.dirname(place), recursive=True)
    own = f"{place}.{os.urandom(6).hex()}"
    with system.open_output_stream(own) as out:
        out.write(data)
    system.move(own, place)


def get_file(path: str) -> bytes | None:
    """A file's content; None where there is no file."""
    system, place = file_system(path)
    try:
        with system.open_input_stream(place) as file:
            return file.read()
    except FileNotFoundError:
        return None


# The following run on the driver and go through Spark's own file systems, whatever store a path is in.


def _hadoop(spark, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def create_once(spark, path: str, content: bytes) -> bool:
    """Create a small file with its content, whole or not at all; False where there is one already.

    Of several writers one succeeds.  Locally a link is made, which fails if the name is taken; other stores refuse to
    create a file that is there.
    """
    local = re.match(r"file:/*(/.*)", path)
    if local or "://" not in path:
        place = local[1] if local else path
        os.makedirs(os.path.dirname(place), exist_ok=True)
        own = f"{os.path.dirname(place)}/.{os.urandom(8).hex()}"
        with open(own, "wb") as file:
            file.write(content)
        try:
            os.link(own, place)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    from py4j.protocol import Py4JJavaError

    system, where = _hadoop(spark, path)
    try:
        out = system.create(where, False)
    except Py4JJavaError as problem:
        if "AlreadyExists" in str(problem.java_exception):
            return False
        raise
    out.write(content)
    out.close()
    return True


def list_names(spark, folder: str) -> list[str]:
    """Names of the files in a folder; none where there is no folder."""
    system, where = _hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def read_bytes(spark, path: str) -> bytes:
    """A small file."""
    system, where = _hadoop(spark, path)
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()
