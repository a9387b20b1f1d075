"""Ids, names and addresses derived from paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom import constants as C


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def base_name(path) -> Column:
    """What follows the last slash."""
    return F.substring_index(_col(path), "/", -1)


def stem(path) -> Column:
    """Base name without its last extension; leading dots are part of the name."""
    return F.regexp_replace(base_name(path), r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")


def parent_name(path) -> Column:
    """Name of the directory that holds the file."""
    return F.element_at(F.split(_col(path), "/"), -2)


def compact_id(identifier) -> Column:
    """Id without slashes, the form used in file names."""
    return F.replace(_col(identifier), F.lit("/"), F.lit(""))


def archive_directory(path, root: str = "latex") -> Column:
    """Directory an archive is unpacked to."""
    return F.concat(F.lit(f"{root}/"), stem(path))


def markup_path(identifier, root: str = "xml") -> Column:
    """Where the converted form of a submission is written."""
    return F.concat(F.lit(f"{root}/"), _col(identifier), F.lit(".xml"))


def log_path(identifier, root: str = "logs") -> Column:
    """Where the conversion log of a submission is written."""
    return F.concat(F.lit(f"{root}/"), _col(identifier), F.lit(".txt"))


def source_url(identifier, base: str = C.EPRINT_URL) -> Column:
    """Download address of a submission's source."""
    return F.concat(F.lit(base), _col(identifier))


def ends_with_any(path, suffixes) -> Column:
    """True where the path ends with one of the suffixes."""
    found = F.lit(False)
    for suffix in suffixes:
        found = found | _col(path).endswith(suffix)
    return found


def member_kind(path) -> Column:
    """Route an archive member by suffix: `pdf`, `gz` or `other`."""
    name = _col(path)
    return (
        F.when(name.endswith(".pdf"), "pdf").when(name.endswith(".gz"), "gz").otherwise("other")
    )


def content_kind(content_type, content_encoding) -> Column:
    """File extension implied by response headers, null where nothing matches."""
    ctype, zipped = _col(content_type), _col(content_encoding) == "x-gzip"
    return (
        F.when(ctype == "application/pdf", ".pdf")
        .when(zipped & (ctype == "application/postscript"), ".ps.gz")
        .when(zipped & (ctype == "application/x-eprint-tar"), ".tar.gz")
        .when(ctype == "application/x-eprint", ".tex")
        .when(zipped & (ctype == "application/x-dvi"), ".dvi.gz")
    )
