"""Projections, casts and filters on flat records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import first_nonblank, list_or_na, or_empty, or_na


def whitelist(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """These columns in this order; one that the table lacks is null."""
    return df.select(
        *[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    )


def renamed(df: DataFrame, names: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed(dict(names)).drop(*drop)


def text_fallback(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """``out`` is the first of ``cols`` with visible text; rows without any are dropped."""
    return df.withColumn(out, first_nonblank(*[F.col(c) for c in cols])).filter(F.col(out).isNotNull())


def fill_na(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``'N/A'`` in place of null and empty text or list columns; numbers stay as they are."""

    def filled(name: str) -> Column:
        kind = df.schema[name].dataType.typeName()
        if kind == "array":
            return list_or_na(F.col(name))
        return or_na(F.col(name)) if kind == "string" else F.col(name)

    return df.withColumns({c: filled(c) for c in columns})


def fill_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: or_empty(F.col(f"`{c}`")) for c in columns})


def clamp(col: Column, low: Column, high: Column, default: Column) -> Column:
    """``default`` outside [low, high]; null stays null."""
    return F.when(~col.between(low, high), default).otherwise(col)


def archive_clamp(col: Column) -> Column:
    """The mail archive's rule: instants outside 1997 to 2003 become 1997-01-01 01:00."""
    kind = "timestamp"
    return clamp(
        col,
        F.lit("1997-01-01 00:00:00").cast(kind),
        F.lit("2003-01-01 00:00:00").cast(kind),
        F.lit("1997-01-01 01:00:00").cast(kind),
    )


def with_value(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every one of these columns or sub-objects is present and not ''."""
    for c in columns:
        present = F.col(c).isNotNull()
        if df.select(c).schema[0].dataType.typeName() == "string":
            present = present & (F.col(c) != "")
        df = df.filter(present)
    return df


def good_and_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Split rows by a reject reason; null means good."""
    judged = df.withColumn("reason", reason)
    return judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL")
