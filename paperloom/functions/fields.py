"""Metadata fields: authors, categories, links, dates, sizes, casts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom import constants as C
from paperloom.functions.text import strip, whitespace_words


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def author_line(authors) -> Column:
    """`First Last, First Last` of the authors that have both elements.

    An empty element counts as present.  No authors give an empty string.
    """
    complete = F.filter(
        _col(authors), lambda a: a.forenames.isNotNull() & a.keyname.isNotNull()
    )
    names = F.transform(
        complete, lambda a: F.concat(strip(a.forenames), F.lit(" "), strip(a.keyname))
    )
    return F.coalesce(F.array_join(names, ", "), F.lit(""))


def name_line(authors) -> Column:
    """All author names of a feed entry, comma separated."""
    names = F.transform(_col(authors), lambda a: a["name"])
    return F.coalesce(F.array_join(names, ", "), F.lit(""))


def link_titled(links, title: str) -> Column:
    """Address of the last link with this title, else null."""
    chosen = F.filter(_col(links), lambda link: link["_title"] == title)
    return F.try_element_at(chosen, F.lit(-1))["_href"]


def category_list(categories) -> Column:
    """White-space separated categories as an array."""
    return whitespace_words(categories)


def first_category(categories) -> Column:
    """Primary category: the first one, null if there is none."""
    return F.get(category_list(categories), F.lit(0))


def category_code(category, codes=None, unmatched: int | None = C.UNMATCHED_CATEGORY_CODE):
    """Integer code of a category.

    By default an unmatched category gets the same code as the first category;
    pass `unmatched=None` or another number to tell them apart.
    """
    chosen = F.lit(None).cast("int") if unmatched is None else F.lit(unmatched)
    for name, code in (codes or C.CATEGORY_CODES).items():
        chosen = F.when(_col(category) == name, F.lit(code)).otherwise(chosen)
    return chosen


def category_in(categories, prefix: str) -> Column:
    """True where the whole category string starts with the prefix."""
    return F.coalesce(_col(categories).startswith(prefix), F.lit(False))


def next_day(day, pattern: str = "yyyy-MM-dd") -> Column:
    """The day after, as text: where the next incremental harvest starts."""
    return F.date_format(F.date_add(F.to_date(_col(day)), 1), pattern)


def as_utc(ts, zone: str = "UTC") -> Column:
    """Read a zone-less time as `zone` and express it in UTC."""
    return F.to_utc_timestamp(_col(ts), zone)


def gigabytes(size, digits: int | None = 2) -> Column:
    value = _col(size) / F.lit(1e9)
    return value if digits is None else F.round(value, digits)


def megabytes(size, digits: int | None = 2) -> Column:
    value = _col(size) / F.lit(1e6)
    return value if digits is None else F.round(value, digits)


def to_number(value, strict: bool = True) -> Column:
    """Text to bigint; strict raises on bad input, lenient gives null."""
    return _col(value).cast("bigint") if strict else _col(value).try_cast("bigint")


def to_time(value, pattern: str | None = None, strict: bool = True) -> Column:
    """Text to timestamp; strict raises on bad input, lenient gives null."""
    convert = F.to_timestamp if strict else F.try_to_timestamp
    if pattern is None:
        return convert(_col(value))
    return convert(_col(value), pattern if strict else F.lit(pattern))


def two_digit_year(yymm, year: str) -> Column:
    """True where a `yymm` string belongs to the two-digit year."""
    return F.substring(_col(yymm), 1, 2) == year


def is_reference_number(label) -> Column:
    """True for labels such as `(12)`, `12` or blank: no author names."""
    return strip(label).rlike(r"^[(]?\p{Nd}*[)]?$")


def has_preamble(content, strict: bool = False) -> Column:
    """True where TeX source has the document class or style command.

    Strict accepts it only at the start of a line, so a commented one is no match.
    """
    return _col(content).rlike(C.STRICT_PREAMBLE if strict else C.PREAMBLE)
