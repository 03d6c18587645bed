"""Date and timestamp expressions that never raise under ANSI mode.

Each accepted layout is recognised by a pattern first, so a row runs one parser instead of
trying ten of them and paying for nine failures.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hireflow.functions.text import clean

_ISO_HEAD = r"^(\d{4})([-/ \\])(\d{1,2})\2(\d{1,2})"
_ISO = _ISO_HEAD + r"([T ]\d{1,2}:.*)?$"

# Numeric layouts and how their groups make year-month-day. Hyphens are day first,
# slashes and dots month first.
_NUMERIC = [
    (r"^(\d{4})\.(\d{1,2})\.(\d{1,2})$", "$1-$2-$3"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$2-$1"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", "$3-$1-$2"),
]

# Layouts with a month name.
_NAMED = [
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2}-[A-Za-z]{4,}-\d{4}$", "d-MMMM-yyyy"),
]

# The classes the date profile reports, in the order they are tried.
DATE_CLASSES = [
    (r"^\d{4}-\d{2}-\d{2}$", "YYYY-MM-DD"),
    (r"^\d{4}/\d{2}/\d{2}$", "YYYY/MM/DD"),
    (r"^\d{4}\.\d{2}\.\d{2}$", "YYYY.MM.DD"),
    (r"^\d{2}-[A-Za-z]{3}-\d{4}$", "DD-Mon-YYYY"),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "Month D, YYYY"),
    (r"^\d{4}-\d{2}-\d{2}T", "ISO timestamp"),
]


def _plain_date(text: Column) -> Column:
    """The common yyyy-mm-dd without any pattern; other year-first texts may come out wrong."""
    return F.when(F.substring(text, 5, 1) == "-", text.try_cast("date"))


def _is_plain(text: Column) -> Column:
    """Whether that date is written exactly like the text."""
    return _plain_date(text).cast("string") == text


def _from_iso(text: Column) -> Column:
    return F.regexp_replace(text, _ISO_HEAD, "$1-$3-$4").try_cast("timestamp_ntz")


def try_timestamp(col: Column) -> Column:
    """Text to timestamp without zone; anything but a year-first date (and time) is NULL.

    A zone suffix is allowed and ignored: the clock time as written counts.
    """
    text = clean(col)
    return F.when(_is_plain(text), _plain_date(text).cast("timestamp_ntz")).when(
        text.rlike(_ISO), _from_iso(text)
    )


def parse_mixed_date(col: Column) -> Column:
    """Text in any accepted layout to DATE, NULL when none fits."""
    text = clean(col)
    parsed = F.when(_is_plain(text), _plain_date(text)).when(
        text.rlike(_ISO), _from_iso(text).cast("date")
    )
    for pattern, order in _NUMERIC:
        parsed = parsed.when(
            text.rlike(pattern), F.regexp_replace(text, pattern, order).try_cast("date")
        )
    for pattern, layout in _NAMED:
        parsed = parsed.when(text.rlike(pattern), F.try_to_date(text, layout))
    return parsed


def date_class(col: Column) -> Column:
    """Name of the layout a raw date text is written in."""
    named = None
    for pattern, name in DATE_CLASSES:
        hit = col.rlike(pattern)
        named = F.when(hit, name) if named is None else named.when(hit, name)
    return named.otherwise("other")


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from start to end."""
    return F.datediff(end, start).cast("bigint")
