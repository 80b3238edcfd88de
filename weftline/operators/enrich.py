"""Lookups in dimension tables, audits of missing keys, positions within a call."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.skew import HOT_ROWS, SMALL_ROWS, hot_keys, is_small, spread_join


def lookup(
    df: DataFrame,
    dim: DataFrame,
    dim_key: str,
    roles: Mapping[str, Mapping[str, str]],
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Join one dimension once per role: ``{"requester_id": {"email": "requester_email"}}``.

    A key without a match keeps its row and gives nulls; ``orphans`` lists them.
    The dimension has one row per key. Up to ``small_rows`` rows it is sent to
    the tasks, so the rows are not shuffled at all; beyond, hot keys (and null
    keys) are spread over tasks.
    """
    fields = {src for out in roles.values() for src in out}
    small = is_small(dim.select(dim_key, *fields), small_rows)
    for key, names in roles.items():
        side = dim.select(
            F.col(dim_key).alias(key), *[F.col(src).alias(out) for src, out in names.items()]
        )
        df = df.join(F.broadcast(side), key, "left") if small else spread_join(df, side, key)
    return df


def lookup_large(df: DataFrame, dim: DataFrame, key: str, spread_by: str, how: str = "left") -> DataFrame:
    """A lookup on one shared key in a table known to be large: hot keys are salted."""
    return spread_join(df, dim, key, spread_by, how)


def orphans(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Keys with no row in the dimension and how many rows carry them; nulls are not orphans.

    Rows are counted per key first, so the join sees each key once.
    """
    used = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(dim_key).alias(key))
    return used.join(known, key, "left_anti")


def relative_position(
    df: DataFrame,
    group: str,
    order: str,
    start: str,
    end: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Start and end of each row as a share of the end of the group's last row.

    "Last" is by position, not the largest end. A last end of 0 gives null. The
    last end is found by aggregation with partial sums, not by a window, so a
    group of any size never meets in one task.
    """
    last = df.groupBy(group).agg(
        F.max_by(end, order).alias("_last_end"), F.count(F.lit(1)).alias("_n")
    )
    hot = hot_keys(last, group, "_n", hot_rows)
    joined = spread_join(df, last.select(group, "_last_end"), group, order, "left", hot=hot, n_rows=0)
    whole = F.nullif(F.col("_last_end").cast("double"), F.lit(0.0))
    return joined.withColumns(
        {
            "relative_start": F.col(start).cast("double") / whole,
            "relative_end": F.col(end).cast("double") / whole,
        }
    ).drop("_last_end")


def align_vectors(df: DataFrame, vectors: DataFrame, id_col: str) -> DataFrame:
    """Rows with their vector, matched by id instead of by position."""
    return df.join(vectors, id_col, "inner")


def unaligned(df: DataFrame, vectors: DataFrame, id_col: str) -> DataFrame:
    """Ids that have a row or a vector but not both."""
    rows = df.select(id_col, F.lit(1).alias("has_row"), F.lit(0).alias("has_vector"))
    vecs = vectors.select(id_col, F.lit(0).alias("has_row"), F.lit(1).alias("has_vector"))
    both = rows.unionByName(vecs).groupBy(id_col).agg(
        F.max("has_row").alias("has_row"), F.max("has_vector").alias("has_vector")
    )
    return both.filter((F.col("has_row") == 0) | (F.col("has_vector") == 0))
