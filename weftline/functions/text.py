"""Cleaning and reshaping of text columns, all inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` computed once per row, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(c), use), 1)


def strip(c: Column) -> Column:
    """Drop blanks, tabs and line ends at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def first_nonblank(*cols: Column) -> Column:
    """The first column with visible text, stripped; null if there is none."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def or_na(c: Column) -> Column:
    """``'N/A'`` for a null or empty text."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("N/A"))


def list_or_na(c: Column, sep: str = ", ") -> Column:
    """A text list joined by ``sep``; ``'N/A'`` for a null or empty list."""
    return F.when(F.size(F.coalesce(c, F.array())) > 0, F.array_join(c, sep)).otherwise("N/A")


def bool_text(c: Column) -> Column:
    """``True`` / ``False`` as text with a capital."""
    return F.initcap(c.cast("string"))


def head(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def part_after_at(c: Column) -> Column:
    """The second part of a mail address split at ``@``; null without one."""
    return F.try_element_at(F.split(c, "@"), F.lit(2))


def host_slug(url: Column) -> Column:
    """The host label after ``//`` and before the first dot; null without one."""
    return F.nullif(F.regexp_extract(url, r"//([^./]+)", 1), F.lit(""))


def host_of(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"//([^/?#]+)", 1), F.lit(""))


def last_segment(path: Column) -> Column:
    """The last path segment, a trailing slash ignored."""
    return strip(F.substring_index(F.rtrim(path, F.lit("/")), "/", -1))


def file_stem(path: Column) -> Column:
    """The file name without its last extension; a leading dot is part of the name."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=[^.])\.[^.]*$", "")


def joined_names(items: Column, field: str, sep: str = ", ") -> Column:
    """One field of every struct in an array as one text; a missing name counts as ''."""
    return F.array_join(F.transform(items, lambda x: or_empty(x[field])), sep)


def joined_texts(items: Column, sep: str = ", ") -> Column:
    return F.array_join(items, sep)


def joined_sorted(items: Column, sep: str = "_") -> Column:
    return F.array_join(F.array_sort(items), sep)


def title_and_subtitle(title: Column, subtitle: Column) -> Column:
    return F.concat(or_empty(title), F.lit(" \n "), or_empty(subtitle))


def deleted_author(author: Column) -> Column:
    return F.coalesce(author, F.lit("[deleted]"))


def thread_id(thread: Column, references: Column, in_reply_to: Column, message_id: Column) -> Column:
    return F.coalesce(F.nullif(thread, F.lit("")), references, in_reply_to, message_id)


def contains_all(c: Column, *words: str) -> Column:
    return reduce(lambda a, b: a & b, [F.contains(c, F.lit(w)) for w in words])


def as_json(*cols: str | Column) -> Column:
    """The columns as one JSON text; letters beyond ASCII stay as they are."""
    return F.to_json(F.struct(*cols))
