"""Dense row numbers and the unique-id contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.storage import cut

_IN_PARTITION = (1 << 33) - 1


def sequential_id(
    df: DataFrame, order_by: Sequence[str | Column], start: int = 0, out: str = "id"
) -> DataFrame:
    """Number all rows from ``start`` without gaps, in the order of unique ``order_by`` columns.

    The table is range-sorted and written once. Each row then knows its place in
    its own partition, and only the row counts of the partitions are summed up,
    so no task sees more than its share of rows.
    """
    placed = cut(df.orderBy(*order_by).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_part")
    place = F.col("_at").bitwiseAND(F.lit(_IN_PARTITION))
    return numbered.withColumn(out, place + F.col("_before") + F.lit(start)).drop("_at", "_part", "_before")


def bad_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Null or repeated ids with their row counts; empty when the contract holds."""
    return (
        df.groupBy(id_col)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) | F.col(id_col).isNull())
    )
