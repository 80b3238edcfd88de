"""Joins that stay even when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.storage import cut

# Keys below this many rows are never worth spreading; the rows of a larger one go to tasks of about as many.
HOT_ROWS = 1_000_000
# Null keys match nothing, so their rows go to so many places.
NULL_SALTS = 64
# A table of at most this many narrow rows may be sent to every task.
SMALL_ROWS = 500_000


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """Whether a table has at most ``max_rows`` rows. The count needs no columns of it."""
    return df.count() <= max_rows


def row_hash(df: DataFrame) -> Column:
    """A hash over the plain columns of a row."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


def hot_keys(counts: DataFrame, key: str, n_col: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """``key, _salts`` for every key of a per-key count that reaches ``hot_rows``: one salt for each ``hot_rows`` rows of it.

    No key is left out, and the table has at most one row for each ``hot_rows``
    rows counted. None if no key is hot.
    """
    salts = F.ceil(F.col(n_col) / F.lit(hot_rows)).cast("int")
    table = cut(counts.filter(F.col(n_col) >= hot_rows).select(key, salts.alias("_salts")))
    return None if table.isEmpty() else table


def hot_keys_of(df: DataFrame, key: str, hot_rows: int = HOT_ROWS, n_rows: int | None = None) -> DataFrame | None:
    """The hot keys of a table; rows are counted per key before any shuffle.

    ``n_rows``, the size of the table where it is known, saves the count for small tables.
    """
    if n_rows is not None and n_rows < hot_rows:
        return None
    return hot_keys(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), key, "_n", hot_rows)


def spread_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    spread_by: str | None = None,
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Join rows to a table with one row per key when both sides may be large.

    Without hot keys (null counts as a key) this is a plain join. Otherwise the
    rows of a hot key are dealt by the hash of ``spread_by`` (of the row if not
    given) to as many salts as the key's size asks for, and only the hot keys' rows
    on the ``one`` side are repeated. The salt is a function of the row, so a re-run
    task repeats it. ``hot`` is the table of ``hot_keys`` where it is at hand, or the
    keys are counted, unless ``n_rows`` rows cannot hold a hot one. ``how`` is
    ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    if hot is None:
        hot = hot_keys_of(many, key, hot_rows, n_rows)
    if hot is None:
        return many.join(one, key, how)
    # A row for each hot_rows rows of the large side at most.
    salts = F.broadcast(hot.select(F.col(key).alias("_hot"), "_salts"))
    mark = F.xxhash64(spread_by) if spread_by else row_hash(many)
    place = F.when(F.col(key).isNull(), F.pmod(mark, F.lit(NULL_SALTS))).otherwise(F.pmod(mark, F.coalesce("_salts", F.lit(1))))
    salted = many.join(salts, F.col(key) == F.col("_hot"), "left").withColumn("_salt", place.cast("int")).drop("_hot", "_salts")
    places = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = one.join(salts, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(places)).drop("_hot", "_salts")
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
