"""XML scans: archive manifests, record harvest pages and API feeds.

Each scan has two halves: a reader, and a `project_*` function that turns the
parsed struct into the flat table.  The projection also serves `from_xml` on a
string column and the streaming reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom import constants as C, schemas as S
from paperloom.functions.fields import author_line, link_titled, name_line
from paperloom.functions.paths import compact_id

# The reference text of an element includes its surrounding blanks.
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "attributePrefix": "_", "mode": "PERMISSIVE"}


def _reader(spark: SparkSession, row_tag: str, schema):
    return (
        spark.read.format("xml").options(**XML_OPTIONS).option("rowTag", row_tag).schema(schema)
    )


def read_manifest(spark: SparkSession, path: str, row_tag: str = C.MANIFEST_ROW) -> DataFrame:
    """One row per archive; a missing tag becomes an empty string."""
    return _reader(spark, row_tag, S.MANIFEST).load(path).na.fill("")


def read_manifest_header(
    spark: SparkSession, path: str, root_tag: str = C.MANIFEST_ROOT
) -> DataFrame:
    """The one timestamp that is a direct child of the manifest root."""
    return _reader(spark, root_tag, "timestamp string").load(path)


def typed_manifest(manifest: DataFrame, strict: bool = True) -> DataFrame:
    """Size as a number and timestamp as a time; `yymm` stays text."""
    from paperloom.functions.fields import to_number, to_time

    return manifest.withColumns({
        "size": to_number("size", strict),
        "timestamp": to_time("timestamp", strict=strict),
    })


def read_harvest_structs(spark: SparkSession, path: str, body_tag: str = C.HARVEST_FORMAT) -> DataFrame:
    """Parsed `<record>` elements, still nested; `body_tag` holds a record's own fields."""
    return _reader(spark, C.HARVEST_ROW, S.harvest_record(body_tag)).load(path)


def harvest_struct(xml, body_tag: str = C.HARVEST_FORMAT) -> Column:
    """Parse a string column holding one `<record>` element each."""
    return F.from_xml(xml, S.harvest_record(body_tag), XML_OPTIONS)


def project_records(structs: DataFrame, *keep: str, body_tag: str = C.HARVEST_FORMAT) -> DataFrame:
    """Nested record -> the 13 text columns; absent elements become null.

    A repeated element gives its first occurrence.  The comment element is read
    under either of its two spellings.
    """
    body = f"metadata.`{body_tag}`"
    return structs.select(
        *keep,
        F.col("header.identifier").alias("identifier"),
        F.col(f"{body}.id").alias("filename"),
        F.get(F.col("header.setSpec"), F.lit(0)).alias("spec"),
        F.col(f"{body}.title").alias("title"),
        F.col("header.datestamp").alias("datestamp"),
        F.col(f"{body}.created").alias("created"),
        F.get(F.col(f"{body}.updated"), F.lit(0)).alias("updated"),
        author_line(F.col(f"{body}.authors.author")).alias("authors"),
        F.col(f"{body}.categories").alias("categories"),
        F.col(f"{body}.`journal-ref`").alias("journal"),
        F.col(f"{body}.doi").alias("doi"),
        F.col(f"{body}.abstract").alias("abstract"),
        F.coalesce(f"{body}.comment", f"{body}.comments").alias("comments"),
    )


def stamp_records(records: DataFrame, retrieved: Column | None = None) -> DataFrame:
    """Add the load time and the compact id, each from the row itself."""
    return records.withColumns({
        "date_retrieved": F.current_timestamp() if retrieved is None else retrieved,
        "filename_parsed": compact_id("filename"),
    })


def read_records(spark: SparkSession, path: str, retrieved: Column | None = None,
                 body_tag: str = C.HARVEST_FORMAT) -> DataFrame:
    """Harvest pages -> `records`."""
    structs = read_harvest_structs(spark, path, body_tag)
    return stamp_records(project_records(structs, body_tag=body_tag), retrieved)


def read_harvest_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Continuation marker of every page that has one.

    An empty marker has null `token`: it is the last page, as is a page without
    a marker.
    """
    tokens = _reader(spark, C.HARVEST_TOKEN, S.HARVEST_TOKEN).load(path)
    return tokens.select(
        F.col("_cursor").try_cast("bigint").alias("cursor"),
        F.col("_completeListSize").try_cast("bigint").alias("complete_list_size"),
        F.nullif(F.trim("_VALUE"), F.lit("")).alias("token"),
        F.col("_metadata.file_path").alias("page"),
    )


def read_response_dates(spark: SparkSession, path: str, root_tag: str = C.HARVEST_ROOT) -> DataFrame:
    """Response date of every page."""
    pages = _reader(spark, root_tag, "responseDate string").load(path)
    return pages.select(
        F.col("responseDate").alias("response_date"), F.col("_metadata.file_path").alias("page")
    )


def read_sets(spark: SparkSession, path: str) -> DataFrame:
    """Set listing: one row per set name."""
    return _reader(spark, C.HARVEST_SET, "setSpec string, setName string").load(path).select("setSpec")


def feed_struct(xml, prefix: str = C.FEED_PREFIX) -> Column:
    """Parse a string column holding one feed `<entry>` each."""
    return F.from_xml(xml, S.feed_entry(prefix), XML_OPTIONS)


def project_feed(structs: DataFrame, *keep: str, prefix: str = C.FEED_PREFIX) -> DataFrame:
    """Nested feed entry -> 12 columns."""
    p = prefix
    return structs.select(
        *keep,
        "id", "updated", "published", "title", "summary",
        name_line("author").alias("authors"),
        F.col(f"`{p}:doi`").alias("doi"),
        link_titled("link", "doi").alias("doi_link"),
        F.col(f"`{p}:journal_ref`").alias("journal"),
        link_titled("link", "pdf").alias("pdf_link"),
        F.col(f"`{p}:primary_category`._term").alias("category"),
        F.col(f"`{p}:comment`").alias("comment"),
    )


def read_feed(spark: SparkSession, path: str, prefix: str = C.FEED_PREFIX) -> DataFrame:
    """API feed pages -> 12-column entries."""
    return project_feed(_reader(spark, C.FEED_ROW, S.feed_entry(prefix)).load(path), prefix=prefix)
