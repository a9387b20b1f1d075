"""Explicit schemas of every table the library reads or writes."""

from pyspark.sql import types as T

from paperloom import constants as C


def _strings(*names):
    return [T.StructField(n, T.StringType(), True) for n in names]


RECORD_FIELDS = (
    "identifier", "filename", "spec", "title", "datestamp", "created", "updated",
    "authors", "categories", "journal", "doi", "abstract", "comments",
)

RECORDS = T.StructType(
    _strings(*RECORD_FIELDS)
    + [T.StructField("date_retrieved", T.TimestampType(), True)]
    + _strings("filename_parsed")
)

MANIFEST = T.StructType(_strings(*C.MANIFEST_FIELDS))

AUTHOR = T.StructType(_strings("keyname", "forenames"))

_many = T.ArrayType(T.StringType())

HARVEST_BODY = T.StructType(
    _strings("id", "created")
    + [
        T.StructField("updated", _many),
        T.StructField(
            "authors", T.StructType([T.StructField("author", T.ArrayType(AUTHOR))])
        ),
    ]
    + _strings("title", "categories", "comment", "comments", "journal-ref", "doi", "abstract")
)


def harvest_record(body_tag: str = C.HARVEST_FORMAT) -> T.StructType:
    """Schema of a harvest record whose fields stand in `body_tag`."""
    return T.StructType([
        T.StructField("header", T.StructType(
            _strings("identifier", "datestamp") + [T.StructField("setSpec", _many)]
        )),
        T.StructField("metadata", T.StructType([T.StructField(body_tag, HARVEST_BODY)])),
    ])


HARVEST_TOKEN = T.StructType(_strings("_VALUE", "_completeListSize", "_cursor"))


def feed_entry(prefix: str = C.FEED_PREFIX) -> T.StructType:
    """Schema of a feed entry whose service-specific elements have `prefix`."""
    return T.StructType(
        _strings("id", "updated", "published", "title", "summary")
        + [
            T.StructField("author", T.ArrayType(T.StructType(_strings("name")))),
            T.StructField("link", T.ArrayType(T.StructType(_strings("_title", "_href")))),
        ]
        + _strings(*(f"{prefix}:{n}" for n in ("doi", "journal_ref", "comment")))
        + [T.StructField(f"{prefix}:primary_category", T.StructType(_strings("_term")))]
    )


SUBJECTS = T.StructType([
    T.StructField("length", T.IntegerType()),
    *_strings("submission_id", "main", "categories"),
])

LAYOUT = T.StructType([
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])

INVENTORY = T.StructType(
    _strings("id", "title", "parent_id", "mime_type")
    + [T.StructField("trashed", T.BooleanType())]
)

ARCHIVE_MEMBERS = T.StructType(
    _strings("tar_name", "member_name", "submission_id", "kind", "error")
    + [T.StructField("content", T.BinaryType())]
)

INNER_FILES = T.StructType(
    _strings("tar_name", "member_name", "submission_id", "inner_path", "kind", "error")
    + [T.StructField("content", T.BinaryType())]
)

MARKUP_FACTS = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("citations", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()), *_strings("class", "key")]))),
    T.StructField("bibitems", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()), *_strings("key", "label")]))),
    T.StructField("error", T.StringType()),
])
