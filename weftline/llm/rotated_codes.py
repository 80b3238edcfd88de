"""Approximate nearest neighbours by randomly rotated one-bit codes.

* **Codes.** A vector's offset from the centre is brought to unit length and
  turned by a random rotation into ``bits`` numbers; their signs, packed, are
  its code. Two scalars stand beside it: the offset's length and ``fit``, the
  inner product of the offset's direction with its own code.
* **Estimates.** The inner product of a code with a rotated query, divided by
  ``fit``, estimates that of the directions without bias. Its error stays below
  ``sqrt(1 - fit^2) / fit * EPSILON / sqrt(bits - 1)`` but for rare cases, so each
  squared distance gets a lower and an upper bound.
* **Reranking.** In a pair of blocks only the candidates whose lower bound is not
  above the ``k``-th least upper bound are measured exactly, in double precision,
  on the original vectors. The best of all pairs of blocks are merged by rank.

Every row is indexed. Only the centre is fitted on a sample, of about
``CENTRE_ROWS`` rows chosen by a hash; it bears on how tight bounds are, not on
what is found. Of equal vectors only the ``k + 1`` smallest ids can ever be among
the nearest, so no more of them are indexed, however many copies there are.

Left out on both sides: null ids, vectors that are null, zero, empty or hold null
or non-finite numbers. Vectors of different lengths are zero beyond their end. A
row is never found for a query with its own id. Rows that repeat id and vector are
one query and, as candidates, one each (up to ``k``); one id with several vectors
is a query for each of them, ranked on its own. Ties go to the smaller id. Fewer
candidates than ``k``: all. Empty table: no rows. Further columns are not looked at.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.blocks import CANDIDATE_BLOCK, QUERY_BLOCK, dense, finite, meet
from weftline.llm.tables import kept

#: Least length of a code, how many deviations the error bound covers, rows that the centre is fitted on.
LEAST_BITS, EPSILON, CENTRE_ROWS, SEED = 512, 2.5, 4096, 11

_SLICE = 128


@lru_cache(4)
def rotation(width: int, bits: int, seed: int) -> np.ndarray:
    """``bits`` x ``width``: the first columns of a random orthogonal matrix, so lengths are kept."""
    drawn = np.random.default_rng(seed).standard_normal((bits, width))
    turned, corner = np.linalg.qr(drawn)
    return turned * np.sign(np.diag(corner))


def _directions(vectors: np.ndarray, centre: np.ndarray, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    offset = vectors - centre
    scale = np.abs(offset).max(axis=1, initial=0.0)
    offset /= np.where(scale > 0, scale, 1)[:, None]
    length = np.sqrt((offset**2).sum(axis=1))
    offset /= np.where(length > 0, length, 1)[:, None]
    return offset @ rotation(len(centre), bits, seed).T, length * scale


def encode(vectors: np.ndarray, centre: np.ndarray, bits: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, lengths and fits of the rows of ``vectors``."""
    turned, length = _directions(vectors, centre, bits, seed)
    return np.packbits(turned >= 0, axis=1), length, np.abs(turned).sum(axis=1) / np.sqrt(bits)


def bounds(
    codes: np.ndarray, length: np.ndarray, fit: np.ndarray, queries: np.ndarray, centre: np.ndarray, epsilon: float, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances, candidates by queries."""
    bits = codes.shape[1] * 8
    turned, far = _directions(queries, centre, bits, seed)
    signs = np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1
    real = fit > 0  # the centre itself has no direction: its inner products are 0
    scale = np.where(real, 1 / (np.sqrt(bits) * np.where(real, fit, 1)), 0)
    about = (signs @ turned.T.astype(np.float32)).astype(np.float64) * scale[:, None]
    # 1e-5 covers the single precision of the product
    error = np.where(real, np.sqrt(np.maximum(0, 1 - fit**2)) / np.where(real, fit, 1) * epsilon / np.sqrt(bits - 1) + 1e-5, 0)
    reach = 2 * length[:, None] * far
    whole = length[:, None] ** 2 + far**2
    low = whole * (1 - 1e-9) - reach * np.minimum(1, about + error[:, None])
    high = whole * (1 + 1e-9) - reach * np.maximum(-1, about - error[:, None])
    return np.nan_to_num(low, nan=-np.inf, neginf=-np.inf), np.nan_to_num(high, nan=np.inf, posinf=np.inf)


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, squares added up place by place."""
    total = np.zeros(len(vectors))
    for column, x in zip(vectors.T, query, strict=True):
        total += (column - x) ** 2
    return np.sqrt(total)


def _search(k: int, centre: np.ndarray, epsilon: float, left: pa.Table, right: pa.Table) -> pa.Table:
    names = ["query_id", "twin", "vec_id", "score"]
    if not left.num_rows or not right.num_rows:
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], names)
    left = left.sort_by("vec_id")
    ids, copies, length, fit = (left[c].to_numpy() for c in ("vec_id", "copies", "length", "fit"))
    width = len(centre)
    vectors, queries = dense(left["v"], width, np.float64), dense(right["v"], width, np.float64)
    packed = left["code"].combine_chunks().cast(pa.large_binary())
    codes = np.frombuffer(packed.buffers()[2], np.uint8).reshape(len(ids), -1) if len(ids) else None
    asked, twins = right["vec_id"].to_numpy(), right["twin"].to_numpy()
    found = []
    np.seterr(over="ignore", invalid="ignore")  # numbers beyond all doubles get bounds that let them through
    for at in range(0, len(asked), _SLICE):
        low, high = bounds(codes, length, fit, queries[at : at + _SLICE], centre, epsilon)
        for j in range(low.shape[1]):
            others = ids != asked[at + j]
            upper = high[others, j]
            most = np.partition(upper, k - 1)[k - 1] if len(upper) > k else np.inf
            near = np.flatnonzero(others & (low[:, j] <= most))
            score = distances(vectors[near], queries[at + j])
            first = np.repeat(np.argsort(score, kind="stable"), copies[near[np.argsort(score, kind="stable")]])[:k]
            found.append((np.full(len(first), at + j), near[first], score[first]))
    rows, near, score = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.table([pa.array(asked[rows]), pa.array(twins[rows]), pa.array(ids[near]), pa.array(score)], names)


def _coded(centre: np.ndarray, bits: int, batches):
    for batch in batches:
        vectors = dense(pa.chunked_array([batch.column(2)]), len(centre), np.float64)
        codes, length, fit = encode(vectors, centre, bits)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(fit)],
            [*batch.schema.names, "code", "length", "fit"],
        )


def index(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 10, bits: int | None = None) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, copies, v, code, length, fit`` of all usable rows, written once, and the centre."""
    number = "double" if vectors.schema[vector].dataType.elementType.simpleString() != "float" else "float"
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("v")).filter(
        F.col("vec_id").isNotNull() & finite("v") & F.exists("v", lambda x: x != 0)
    )
    once = usable.select("vec_id", F.col("v").cast(f"array<{number}>").alias("v")).groupBy("vec_id", "v").agg(
        F.least(F.count(F.lit(1)), F.lit(k)).alias("copies")
    )
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    rows = kept(once.withColumn("place", place).filter(F.col("place") <= k + 1).select("vec_id", "copies", "v"), "vectors")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = width or 1
    few = rows.filter(F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(1, n // CENTRE_ROWS))) == 0)
    sums = few.select(F.posexplode("v")).groupBy("pos").agg(F.sum(F.col("col").cast("double")).alias("x")).collect()
    centre = np.zeros(width)
    for row in sums:
        centre[row["pos"]] = row["x"] / max(1, n / max(1, n // CENTRE_ROWS))
    centre[~np.isfinite(centre)] = 0
    bits = bits or -(-max(width, LEAST_BITS) // 64) * 64
    schema = f"vec_id long, copies long, v array<{number}>, code binary, length double, fit double"
    coded = rows.mapInArrow(partial(_coded, centre, bits), schema)
    return kept(coded, "codes"), centre


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = 10, bits: int | None = None,
    epsilon: float = EPSILON, candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of every row that ``is_query`` (of ``id_col``) marks."""
    coded, centre = index(vectors, id_col, vector, k, bits)
    # Queries come from the table itself: the index leaves out copies beyond the k-th.
    kind = coded.schema["v"].dataType.simpleString()
    asked = vectors.filter(is_query).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    asked = asked.filter(F.col("vec_id").isNotNull() & finite("v") & F.exists("v", lambda x: x != 0))
    queries = kept(
        asked.select("vec_id", F.col("v").cast(kind).alias("v")).distinct().withColumn("twin", F.xxhash64("v")), "queries"
    )
    best = meet(
        coded, queries, coded.count(), queries.count(), lambda: F.xxhash64("vec_id", "v"),
        partial(_search, k, centre, epsilon), "query_id long, twin long, vec_id long, score double", candidate_block, query_block,
    )
    order = Window.partitionBy("query_id", "twin").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
