"""Vectors in blocks: a query set against all rows, one pair of blocks in a task.

Used by the operators that search vectors. A row takes part if its id is not
null and its vector is not null and holds neither null nor non-finite numbers.
Vectors of different lengths are zero beyond their end.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CANDIDATE_BLOCK, QUERY_BLOCK = 8192, 4096


def finite(vector: str) -> Column:
    """Whether a vector is there and holds only finite numbers."""
    return F.col(vector).isNotNull() & F.forall(
        F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )


def dense(column: pa.ChunkedArray, width: int, dtype: type) -> np.ndarray:
    """List rows as a matrix, zero beyond their ends."""
    lists = column.combine_chunks()
    lengths = np.asarray(lists.value_lengths(), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.astype(dtype).reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def blocks_of(n: int, size: int) -> int:
    return max(1, -(-n // size))


def meet(
    candidates: DataFrame, queries: DataFrame, n_candidates: int, n_queries: int, spot: Callable[[], Column],
    search: Callable[[pa.Table, pa.Table], pa.Table], schema: str, candidate_block: int, query_block: int,
) -> DataFrame:
    """Every block of candidates with every block of queries; ``spot`` is the hash that deals both to blocks.

    ``search`` gets the two tables of one pair of blocks and gives that pair's best rows.
    """
    c, q = blocks_of(n_candidates, candidate_block), blocks_of(n_queries, query_block)
    left = candidates.withColumn("c", F.pmod(spot(), F.lit(c))).withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q - 1).cast("long"))))
    right = queries.withColumn("q", F.pmod(spot(), F.lit(q))).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c - 1).cast("long"))))
    return left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(search, schema)
