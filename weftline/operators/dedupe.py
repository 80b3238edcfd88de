"""One row per text, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ranked(order_by: Sequence[str]) -> Column:
    """A sort key in which null comes after every value."""
    return F.struct(*[x for c in order_by for x in (F.col(c).isNull(), F.col(c))])


def exact_dedupe(
    df: DataFrame, text: str, order_by: Sequence[str], keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per distinct text with the columns of its first copy, and the number of ``copies``.

    First is by ``order_by``, which must be a total order (end it with an id).
    Rows of one text are merged before the shuffle, so a text that fills a third
    of the table costs one row per map task. The hash leads the key: grouping
    compares long texts only where hashes agree.
    """
    kept = list(keep) if keep is not None else [c for c in df.columns if c != text]
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in kept]), _ranked(order_by))
    return (
        df.groupBy(F.xxhash64(text).alias("_hash"), F.col(text))
        .agg(first.alias("_first"), F.count(F.lit(1)).alias("copies"))
        .select(text, "_first.*", "copies")
    )


def by_copies(df: DataFrame, id_col: str) -> DataFrame:
    """Most copied first, then by id."""
    return df.orderBy(F.desc("copies"), id_col)


def latest_by_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of every key by a total order: what a repeated dict write leaves."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    order = F.struct(*[x for c in order_by for x in (F.col(c).isNotNull(), F.col(c))])
    return (
        df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_last")).select(*keys, "_last.*")
    )


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct() if cols else df.distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column that a frame lacks is null there."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def unvisited(df: DataFrame, visited: DataFrame, key: str) -> DataFrame:
    return df.join(visited.select(key), key, "left_anti")


def overlap(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """How many distinct keys two result lists share, as one row."""
    both = left.select(*keys).intersect(right.select(*keys))
    return both.agg(F.count(F.lit(1)).alias("shared"))
