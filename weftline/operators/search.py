"""Exact, truncated and two-phase nearest-neighbour search.

Queries are a table. A set that fits one block (``BLOCK_QUERIES`` rows and
``BLOCK_BYTES``, both counted) goes to the tasks that hold the corpus, which is then
scanned in place: every task multiplies its Arrow batches with the block and passes
on its ``k`` best rows a query. A larger set stays distributed: corpus and queries
are dealt to blocks, each pair of blocks meets in one task, and the bests are merged
by rank. ``operators.cells`` prunes the corpus by cells of a stored layout.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.vectors import dot, truncated
from weftline.storage import cut

#: The largest query block: what a scan sends to all tasks has a fixed bound.
BLOCK_QUERIES, BLOCK_BYTES = 2048, 32 << 20
#: Rows of the corpus in a block when queries stay distributed.
BLOCK_ROWS = 8192
#: Scores that are held at once; a block of the corpus meets that many of its queries at a time, one at least.
SCORES_AT_ONCE = 1 << 19
# Result lists below this many bytes are sent to the tasks that hold the corpus.
BROADCAST_BYTES = 32 << 20
# Scores are rounded here, so equal vectors tie however a product was blocked.
SCORE_DIGITS = 12


def usable(vec: str, width: int) -> Column:
    """Whether a vector has ``width`` numbers, all finite."""
    good = F.forall(F.col(vec), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) == width) & good, F.lit(False))


def left_out(corpus: DataFrame, width: int, id_col: str = "id", vec: str = "embedding") -> DataFrame:
    """``id, reason`` of the rows that a search with queries of ``width`` numbers cannot rank."""
    reason = (
        F.when(F.col(vec).isNull(), "no vector").when(F.size(vec) != width, "another length").otherwise("a number that is not finite")
    )
    return corpus.filter(~usable(vec, width)).select(F.col(id_col).alias("id"), reason.alias("reason"))


def _asked(queries: DataFrame, qid: str, vec: str) -> tuple[DataFrame, int, int]:
    """The queries with a vector, written once; their number and the length of the longest."""
    rows = cut(queries.select(F.col(qid).alias("qid"), F.col(vec).alias("v"))).filter("v IS NOT NULL")
    n, n_ids, width = rows.agg(F.count(F.lit(1)), F.count_distinct(F.struct("qid")), F.max(F.size("v"))).first()
    if n_ids < n:
        raise ValueError("query ids must be unique")
    return rows, n, width or 0


def _k_best(found: pd.DataFrame, k: int, by: str = "score") -> pd.DataFrame:
    ordered = found.sort_values(["q", by, "id"], ascending=[True, False, True], kind="stable")
    return ordered.groupby("q", sort=False).head(k)


def _at_unit_length(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at unit length, and which rows have a direction at all."""
    lengths = np.sqrt((vectors**2).sum(axis=1))
    usable_rows = lengths > 0
    return vectors[usable_rows] / lengths[usable_rows, None], usable_rows


def _vectors(column: pa.Array | pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of ``width`` finite numbers as a matrix, and their rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), width), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    matrix = flat.astype(np.float64).reshape(len(rows), width)
    finite = np.isfinite(matrix).all(axis=1)  # a null number is not finite either
    return matrix[finite], rows[finite]


def slices(n: int, each: int) -> Iterator[slice]:
    """``n`` items in runs for which ``SCORES_AT_ONCE`` suffices, if every item asks for ``each``."""
    step = max(1, SCORES_AT_ONCE // max(1, each))
    return (slice(at, at + step) for at in range(0, n, step))


def best_rows(vectors: np.ndarray, queries: np.ndarray, k: int, metric: str, floor: np.ndarray | float = -np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, queries and scores of at least the ``k`` best rows of each query, none below ``floor``; larger is better.

    Euclidean distances are sifted by their product form, within its rounding, and
    measured exactly for what is left.
    """
    if not len(vectors) or not len(queries):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    floor = np.broadcast_to(floor, len(queries))
    found = []
    for part in slices(len(queries), len(vectors)):
        rows, cols, scores = _best_of_few(vectors, queries[part], k, metric, floor[part])
        found.append((rows, cols + part.start, scores))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _best_of_few(vectors: np.ndarray, queries: np.ndarray, k: int, metric: str, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if metric == "dot":
        scores = np.round(vectors @ queries.T, SCORE_DIGITS)
        low = scores
    else:
        own, far = (vectors**2).sum(axis=1)[:, None], (queries**2).sum(axis=1)
        squares = own + far - 2 * (vectors @ queries.T)
        slack = 1e-9 * (own + far) + 1e-11
        scores, low = -np.sqrt(np.maximum(0, squares - slack)), -np.sqrt(np.maximum(0, squares + slack))
    if len(vectors) > k:
        kth = np.partition(low, len(vectors) - k, axis=0)[len(vectors) - k]
        rows, cols = np.nonzero(scores >= np.maximum(kth, floor))
    else:
        rows, cols = np.nonzero(scores >= floor)
    if metric == "dot":
        return rows, cols, scores[rows, cols]
    return rows, cols, -np.round(np.sqrt(((vectors[rows] - queries[cols]) ** 2).sum(axis=1)), SCORE_DIGITS)


def _scan(
    k: int, metric: str, dims: int | None, full: bool, names: np.ndarray, asked, sent: pa.DataType, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """The ``k`` best rows of one corpus partition for every query; ``full`` adds the score of the whole vectors."""
    whole = asked.value
    width = whole.shape[1]
    queries, keep = whole, np.ones(len(whole), bool)
    if dims is not None:
        queries, keep = _at_unit_length(whole[:, :dims])
        whole, names = whole[keep], names[keep]
    floor = np.full(len(queries), -np.inf)
    best = pd.DataFrame({"q": [], "score": [], "id": []})
    for batch in batches:
        vectors, rows = _vectors(batch.column(1), width if full or dims is None else min(dims, width))
        head = vectors
        if dims is not None:
            head, keep = _at_unit_length(vectors[:, :dims])
            vectors, rows = vectors[keep], rows[keep]
        ids = batch.column(0).to_pandas().to_numpy()[rows]
        at, cols, scores = best_rows(head, queries, k, metric, floor)
        if len(at) == 0:
            continue
        found = pd.DataFrame({"q": cols, "score": scores, "id": ids[at]})
        if full:
            found["exact"] = np.round((vectors[at] * whole[cols]).sum(axis=1), SCORE_DIGITS)
        best = _k_best(pd.concat([best, found]) if len(best) else found, k)
        filled = best.groupby("q")["score"].agg(["size", "min"])
        filled = filled[filled["size"] == k]
        floor[filled.index.to_numpy(dtype=int)] = filled["min"].to_numpy()
    if len(best):
        sign = 1.0 if metric == "dot" else -1.0
        columns = {"qid": pa.array(names[best["q"].to_numpy(dtype=int)].tolist(), sent), "id": best["id"].to_numpy(), "score": best["score"].to_numpy() * sign}
        if full:
            columns["exact"] = best["exact"].to_numpy()
        yield pa.RecordBatch.from_pydict(columns)


def _scan_search(
    corpus: DataFrame, rows: DataFrame, width: int, k: int, metric: str, id_col: str, vec: str, dims: int | None, full: bool = False
) -> DataFrame:
    """One scan of the corpus with one bounded block of queries."""
    block = rows.filter(usable("v", width)).toArrow()
    asked = np.stack([np.asarray(v, np.float64) for v in block["v"].to_pylist()]) if block.num_rows else np.zeros((0, width))
    matrix = corpus.sparkSession.sparkContext.broadcast(asked)
    names = np.array(block["qid"].to_pylist(), object)
    kinds = rows.schema["qid"].dataType.simpleString(), corpus.schema[id_col].dataType.simpleString()
    short = dims is not None and dims < width and not full
    head = F.when(F.size(vec) == width, F.slice(vec, 1, dims)) if short else F.col(vec)
    schema = f"qid {kinds[0]}, id {kinds[1]}, score double" + ", exact double" * full
    job = partial(_scan, k, metric, dims, full, names, matrix, block.schema.field("qid").type)
    return corpus.select(id_col, head.alias("v")).mapInArrow(job, schema)


def _pair_of_blocks(k: int, metric: str, dims: int | None, width: int, kinds: list[pa.DataType], left: pa.Table, right: pa.Table) -> pa.Table:
    """The ``k`` best rows of a block of the corpus (``left``) for each query of a block (``right``)."""
    vectors, rows = _vectors(left["v"], width)
    queries, cols = _vectors(right["v"], width)
    if dims is not None:
        vectors, keep = _at_unit_length(vectors[:, :dims])
        rows = rows[keep]
        queries, keep = _at_unit_length(queries[:, :dims])
        cols = cols[keep]
    ids = left["id"].to_pandas().to_numpy()
    kept = [pd.DataFrame({"q": np.empty(0, np.int64), "score": np.empty(0), "id": ids[:0]})]
    for part in slices(len(queries), len(vectors)):  # equal vectors tie, so a query may find the whole block
        at, q, score = best_rows(vectors, queries[part], k, metric)
        kept.append(_k_best(pd.DataFrame({"q": q + part.start, "score": score, "id": ids[rows[at]]}), k))
    best = pd.concat(kept[1:] or kept)
    sign = 1.0 if metric == "dot" else -1.0
    return pa.table(
        {
            "qid": right["qid"].take(pa.array(cols[best["q"].to_numpy(int)])).cast(kinds[0]),
            "id": pa.array(best["id"].tolist(), kinds[1]),
            "score": best["score"].to_numpy() * sign,
        }
    )


def meet(left: DataFrame, right: DataFrame, keys: Sequence[str], k: int, metric: str, width: int, dims: int | None = None) -> DataFrame:
    """``qid, id, score``: the ``k`` best of the rows (``id, v``) with the queries (``qid, v``) that share ``keys``."""
    sample = left.sparkSession.createDataFrame([], f"q {right.schema['qid'].dataType.simpleString()}, i {left.schema['id'].dataType.simpleString()}")
    kinds = [f.type for f in sample.toArrow().schema]
    schema = ", ".join(f"{c} {t.schema[c].dataType.simpleString()}" for c, t in (("qid", right), ("id", left))) + ", score double"
    job = partial(_pair_of_blocks, k, metric, dims, width, kinds)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(job, schema)


def _block_search(
    corpus: DataFrame, rows: DataFrame, n: int, width: int, k: int, metric: str, id_col: str, vec: str, dims: int | None
) -> DataFrame:
    """Blocks of the corpus with blocks of queries; neither passes through the driver."""
    held = cut(corpus.select(F.col(id_col).alias("id"), F.col(vec).alias("v")))
    c, q = max(1, -(-held.count() // BLOCK_ROWS)), max(1, -(-n // BLOCK_QUERIES))
    left = held.withColumn("c", F.pmod(F.xxhash64("id", "v"), F.lit(c))).withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q - 1).cast("long"))))
    right = rows.withColumn("q", F.pmod(F.xxhash64("qid"), F.lit(q))).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c - 1).cast("long"))))
    return meet(left, right, ["c", "q"], k, metric, width, dims)


def _ranked(found: DataFrame, k: int, ascending: bool) -> DataFrame:
    score = F.asc("score") if ascending else F.desc("score")
    place = F.row_number().over(Window.partitionBy("qid").orderBy(score, "id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def _near(hits: DataFrame, n_rows: int) -> DataFrame:
    """``qid, id`` and numbers, at about 64 bytes a row."""
    return F.broadcast(hits) if n_rows * 64 <= BROADCAST_BYTES else hits


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    metric: str = "dot",
    qid: str = "qid",
    id_col: str = "id",
    vec: str = "embedding",
    fields: Sequence[str] = (),
    dims: int | None = None,
) -> DataFrame:
    """The ``k`` best corpus rows of every query: ``qid, id, score, rank`` and ``fields``.

    Best first, ties by id. ``metric`` is ``dot`` (largest first) or
    ``euclidean`` (smallest first). Vectors that are null, of another length
    than the queries or not finite are left out; query ids must be unique. ``dims`` searches on the first ``dims``
    numbers at unit length, without the vectors that are zero there; the rest of
    a vector then never leaves the scan.
    """
    rows, n, width = _asked(queries, qid, vec)
    if not n:
        kinds = [
            f"qid {queries.schema[qid].dataType.simpleString()}",
            f"id {corpus.schema[id_col].dataType.simpleString()}",
            "score double",
            "rank int",
            *(f"`{f}` {corpus.schema[f].dataType.simpleString()}" for f in fields),
        ]
        return corpus.sparkSession.createDataFrame([], ", ".join(kinds))
    if _one_block(n, width):
        found = _scan_search(corpus, rows, width, k, metric, id_col, vec, dims)
    else:
        found = _block_search(corpus, rows, n, width, k, metric, id_col, vec, dims)
    hits = _ranked(found, k, ascending=metric != "dot").select("qid", "id", "score", "rank")
    if not fields:
        return hits
    side = corpus.select(F.col(id_col).alias("id"), *fields)
    return side.join(_near(hits, n * k), "id").select("qid", "id", "score", "rank", *fields)


def _one_block(n: int, width: int) -> bool:
    return n <= BLOCK_QUERIES and n * width * 8 <= BLOCK_BYTES


def with_fields(hits: DataFrame, df: DataFrame, fields: Sequence[str], id_col: str = "id") -> DataFrame:
    """Hits with columns of another table, matched by id.

    The hits are computed once and measured: a short list goes to the tasks that
    hold the table, a long one is joined by shuffle.
    """
    once = cut(hits)
    side = df.select(F.col(id_col).alias("id"), *fields)
    size = once.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return side.join(F.broadcast(once) if size <= BROADCAST_BYTES else once, "id").select(*hits.columns, *fields)


def truncate(df: DataFrame, dims: int, vec: str = "embedding") -> DataFrame:
    """Vectors cut to their first ``dims`` numbers at unit length; zero vectors are left out.

    The input keeps its own vectors: nothing is changed in place.
    """
    nonzero = F.exists(F.slice(vec, 1, dims), lambda x: x != 0)
    return df.filter(nonzero).withColumn(vec, truncated(F.col(vec), dims))


def knn_rerank(
    queries: DataFrame,
    corpus: DataFrame,
    dims: int,
    k: int = 10,
    expand: int = 10,
    qid: str = "qid",
    id_col: str = "id",
    vec: str = "embedding",
    short: DataFrame | None = None,
) -> DataFrame:
    """Find ``k * expand`` candidates on truncated vectors, then rank them by the full ones.

    ``short`` is the truncated corpus when it is already at hand (truncate once,
    write it, search it often); full vectors are then fetched by id. Without it a
    scan passes over the full vectors anyway, so the candidates of a task get
    their full score there, and neither a second scan nor a join is needed.
    """
    wide = k * expand
    rows, n, width = _asked(queries, qid, vec)
    if short is None and n and _one_block(n, width):
        found = _scan_search(corpus, rows, width, wide, "dot", id_col, vec, dims, full=True)
        few = _ranked(found, wide, ascending=False).select("qid", "id", F.col("exact").alias("score"))
        return _ranked(few, k, ascending=False)
    asked = rows.select(F.col("qid"), F.col("v").alias(vec))
    if short is None:
        few = knn(asked, corpus, wide, id_col=id_col, vec=vec, dims=dims)
    else:
        few = knn(truncate(asked, dims, vec), short, wide, id_col=id_col, vec=vec)
    full = corpus.select(F.col(id_col).alias("id"), F.col(vec).alias("_full"))
    pairs = full.join(_near(few.select("qid", "id"), n * wide), "id").join(asked.withColumnRenamed(vec, "_asked"), "qid")
    scored = pairs.select("qid", "id", F.round(dot(F.col("_full"), F.col("_asked")), SCORE_DIGITS).alias("score"))
    return _ranked(scored, k, ascending=False)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Per query, how many rows of the exact list were found, and that as a share."""
    hit = found.select("qid", "id", F.lit(1).alias("_hit"))
    return (
        exact.select("qid", "id")
        .join(hit, ["qid", "id"], "left")
        .groupBy("qid")
        .agg(F.count("_hit").alias("shared"), F.count(F.lit(1)).alias("k"))
        .select("qid", "shared", (F.col("shared") / F.col("k")).alias("recall"))
    )
