"""Resolving links against the page they stand on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def _without_dots(path: Column) -> Column:
    """Work ``.`` and ``..`` segments out of an absolute path."""
    segments = F.split(path, "/")
    empty = F.slice(segments, 1, 0)
    kept = F.aggregate(
        segments,
        empty,
        lambda acc, s: F.when(s == ".", acc)
        # The first entry is the empty text before the leading slash; it stays.
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    to_folder = path.rlike(r"/\.\.?$")
    joined = F.array_join(kept, "/")
    return F.when(to_folder & ~F.endswith(joined, F.lit("/")), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve(base: Column, link: Column) -> Column:
    """``link`` as an absolute http address; null for fragments and other schemes."""
    link = F.btrim(link)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(
        F.nullif(F.regexp_extract(base_path, r"^(.*/)[^/]*$", 1), F.lit("")), F.lit("/")
    )
    path = F.regexp_extract(link, r"^([^?#]*)", 1)
    tail = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    return (
        F.when(link.rlike(r"^(?i)https?://"), link)
        .when(link.rlike(_ABSOLUTE) | F.startswith(link, F.lit("#")), F.lit(None).cast("string"))
        .when(link == "", base)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .when(F.startswith(link, F.lit("?")), F.concat(site, base_path, link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, _without_dots(path), tail))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, path)), tail))
    )
