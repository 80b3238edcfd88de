"""Counts: keys of open maps, facets, distinct values, fixed-size samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_keys(df: DataFrame, map_col: str, n: int = 21) -> DataFrame:
    """The ``n`` most frequent keys of a map column, ties by key."""
    keys = df.select(F.explode(F.map_keys(map_col)).alias("key"))
    return top_values(keys, "key", n)


def top_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of a column with their counts, ties by value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col).limit(n)


def promote_keys(df: DataFrame, map_col: str, names: list[str]) -> DataFrame:
    """Map entries as columns of their own; a missing key is null."""
    return df.withColumns({k: F.try_element_at(F.col(map_col), F.lit(k)) for k in names})


def fixed_sample(df: DataFrame, id_col: str, n: int, seed: int = 0) -> DataFrame:
    """A uniform sample of exactly ``n`` rows, the same on every run with this seed."""
    mark = F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")).cast("binary"))
    return df.withColumn("_mark", mark).orderBy("_mark", id_col).limit(n).drop("_mark")


def distinct_per_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """The distinct values of every group, one row each, with their counts; blanks are left out."""
    seen = df.filter(F.col(value).isNotNull() & (F.col(value) != ""))
    return seen.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))


def facets(df: DataFrame, *fields: str) -> DataFrame:
    return df.groupBy(*fields).agg(F.count(F.lit(1)).alias("n"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))
