"""Exact top-k by integer inner product: exhaustive term-at-a-time accumulation.

Vectors are split into blocks of bounded size, queries too, and each pair of
blocks meets in one task. There the candidates' numbers are turned into posting
lists, one per dimension, and the query rows are kept sparse: every non-zero
weight of a query scatters ``weight * posting`` into the dense scores of the
block. A partition selection keeps the block's ``k`` best; the bests of all
blocks are merged by rank. The work is queries times candidates by nature; no
task holds more than one block of each and nothing passes through the driver but
two row counts.

Left out on both sides: a null id, a null vector, and a vector with a null or
non-finite number. Vectors of different lengths are zero beyond their end. A row
is never a candidate of a query with its own id. Repeated rows are candidates
each. Repeated query rows share the ranks of their id, as in the query's SQL: a
candidate stands there once for each of them. Ties go to the smaller id. Empty table: no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.storage import scratch_path

CANDIDATE_BLOCK, QUERY_BLOCK = 8192, 4096


def _dense(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def block_top(k: int, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The ``k`` best candidates (``left``) of every query (``right``) in one pair of blocks."""
    if not len(left) or not len(right):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    left = left.sort_values("vec_id", kind="stable")
    ids = left["vec_id"].to_numpy(np.int64)
    width = max(map(len, [*left["v"], *right["v"]]))
    table = _dense(left["v"], width)
    postings = []
    for column in table.T:
        rows = np.flatnonzero(column)
        postings.append((rows if len(rows) < len(ids) else slice(None), column[rows]))
    found = []
    for query, weights in zip(right["vec_id"], _dense(right["v"], width), strict=True):
        scores = np.zeros(len(ids), np.int64)
        for term in np.flatnonzero(weights):
            rows, values = postings[term]
            scores[rows] += weights[term] * values
        place = np.flatnonzero(ids != query)
        own = scores[place]
        if len(own) > k:
            least = np.partition(own, len(own) - k)[len(own) - k]
            above = place[own > least]
            place = np.concatenate([above, place[own == least][: k - len(above)]])  # ids ascend
        found.append((np.full(len(place), query), ids[place], scores[place]))
    q, v, s = (np.concatenate(x) for x in zip(*found, strict=True))
    return pd.DataFrame({"query_id": q, "vec_id": v, "score": s})


def top_k(
    vectors: DataFrame, is_query, id_col: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024,
    candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that ``is_query`` (a column) marks."""
    spark = vectors.sparkSession
    number = lambda x: x.cast("double")
    whole = F.forall(
        F.col("e"), lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < F.lit(float("inf")))
    )
    kept = scratch_path(spark, "vectors")
    (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("e"), is_query.alias("is_query"))
        .filter(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & whole)
        .select("vec_id", F.transform("e", lambda x: F.floor(number(x) * scale)).alias("v"), "is_query")
        .write.parquet(kept)
    )
    rows = spark.read.parquet(kept)
    n, n_queries = rows.count(), rows.filter("is_query").count()
    blocks, query_blocks = max(1, -(-n // candidate_block)), max(1, -(-n_queries // query_block))
    spot = F.xxhash64("vec_id")
    candidates = rows.select(
        "vec_id", "v", F.pmod(spot, F.lit(blocks)).alias("c"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"),
    )
    queries = rows.filter("is_query").select(
        "vec_id", "v", F.pmod(spot, F.lit(query_blocks)).cast("int").alias("q"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("c"),
    )
    bests = (
        candidates.groupBy("c", "q")
        .cogroup(queries.groupBy("c", "q"))
        .applyInPandas(partial(block_top, k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        bests.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
