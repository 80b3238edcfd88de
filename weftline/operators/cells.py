"""Exact search over a clustered layout of the corpus.

The layout holds every usable row in its nearest k-means cell, one folder for each
cell, and a table of cells with centre, radius and number of rows. For a query no
row of a cell can score above ``q . centre + |q| * radius`` (nor lie nearer than the
distance to the centre less the radius). A search visits each query's best cells
first, as many as hold ``k`` rows; the ``k``-th score found there rules out all
cells whose bound is below it, and only the others are visited then. The result is
that of a full scan; what was skipped is counted.

Rows of a cell, and queries with one best cell, are packed into blocks of a bounded size
and written once. A task has a few blocks of queries and reads the blocks of the corpus
one after another from the shared folder, so nothing is repeated in a shuffle: a search
moves and writes every vector a fixed number of times, however many pairs of blocks meet.
Only the cell table, ``MAX_CELLS`` rows at most, is sent to all tasks.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.search import BLOCK_ROWS, SCORE_DIGITS, SCORES_AT_ONCE, _k_best, _ranked, _vectors, best_rows, slices, usable
from weftline.operators.tables import in_batches
from weftline.storage import scratch_path

#: Cells, rows that k-means is fitted on, and its rounds.
MAX_CELLS, SAMPLE_ROWS, ROUNDS = 1024, 65_536, 8

#: Queries in a block, bytes of the vectors of a block, and of those that a task holds for blocks that are not full.
BLOCK_QUERIES, BLOCK_BYTES, PACKED_BYTES = 8192, 4 << 20, 64 << 20

#: Files of a layout that tasks write straight from the scan; for more, rows are first brought together by cell.
CELL_FILES = 4096

#: Tasks for each core that search first cells and then other cells, at least, if there are blocks for them. First cells
#: give ``k`` rows a query and share of the corpus; the others few, but they are most of the work, and tasks differ.
FIRST_TASKS, OTHER_TASKS = 4, 8

_SLACK = 1e-9


@dataclass
class Layout:
    """``rows`` (``id, v, cell``) and, in the order of their numbers, centre, radius and size of the cells."""

    rows: DataFrame
    centres: np.ndarray
    radius: np.ndarray
    size: np.ndarray

    @property
    def width(self) -> int:
        return self.centres.shape[1]


def _nearest_cell(centres: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    far = (centres**2).sum(axis=1)
    for batch in (whole.slice(part.start, part.stop - part.start) for whole in batches for part in slices(whole.num_rows, len(centres))):
        vectors, _ = _vectors(batch.column(1), centres.shape[1])
        cell = (far - 2 * (vectors @ centres.T)).argmin(axis=1) if len(vectors) else np.empty(0, np.int64)
        away = np.sqrt(((vectors - centres[cell]) ** 2).sum(axis=1))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], ["id", "v", "cell", "away"])


def _numbers(df: DataFrame, vec: str) -> str:
    """The type in which vectors are kept: floats stay floats, all else is double."""
    kind = df.schema[vec].dataType.simpleString()
    return kind if kind == "array<float>" else "array<double>"


def build_layout(corpus: DataFrame, path: str | None = None, n_cells: int | None = None, id_col: str = "id", vec: str = "embedding", seed: int = 0) -> Layout:
    """Write the layout of all usable vectors to ``path`` (the shared folder if none is given) and open it.

    The length of the first vector by id decides; ``search.left_out`` lists the rows
    that have another or cannot be ranked. K-means is fitted on about ``SAMPLE_ROWS``
    rows chosen by a hash; every row gets a cell.
    """
    spark = corpus.sparkSession
    path = path or scratch_path(spark, "layout")
    numbers = _numbers(corpus, vec)
    named = corpus.select(F.col(id_col).alias("id"), F.col(vec).cast(numbers).alias("v"))
    first = named.filter("v IS NOT NULL").agg(F.min_by(F.size("v"), "id")).first()[0] or 0
    rows = named.filter(usable("v", first))
    n = rows.count()
    n_cells = min(n_cells or -(-n // BLOCK_ROWS), MAX_CELLS, max(1, n))
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(max(1, n // SAMPLE_ROWS))) == 0).select(array_to_vector(F.col("v").cast("array<double>")).alias("features"))
    if n_cells > 1:
        model = KMeans(k=n_cells, seed=seed, maxIter=ROUNDS).fit(sample)
        centres = np.array(model.clusterCenters())
    else:
        centres = np.zeros((1, first))
    kind = corpus.schema[id_col].dataType.simpleString()
    placed = rows.mapInArrow(partial(_nearest_cell, centres), f"id {kind}, v {numbers}, cell int, away double")
    if n_cells <= 64:
        placed = placed.coalesce(CELL_FILES // max(1, n_cells))  # every task may hold rows of every cell
    else:
        placed = placed.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(max(1, n // BLOCK_ROWS))))
    placed.write.partitionBy("cell").parquet(f"{path}/rows")
    table = spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(centres)], "cell int, centre array<double>")  # MAX_CELLS rows at most
    cells = spark.createDataFrame([], "cell int, radius double, size long")
    if n:
        cells = spark.read.parquet(f"{path}/rows").groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("size"))
    table.join(cells, "cell").write.parquet(f"{path}/cells")
    return open_layout(spark, path)


def open_layout(spark: SparkSession, path: str) -> Layout:
    """A layout written before."""
    found = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # MAX_CELLS rows at most
    n = found[-1]["cell"] + 1 if found else 1
    width = len(found[0]["centre"]) if found else 1
    centres, radius, size = np.zeros((n, width)), np.zeros(n), np.zeros(n, np.int64)
    for r in found:
        centres[r["cell"]], radius[r["cell"]], size[r["cell"]] = r["centre"], r["radius"], r["size"]
    rows = spark.read.parquet(f"{path}/rows").select("id", "v", "cell") if found else spark.createDataFrame([], "id long, v array<double>, cell int")
    return Layout(rows, centres, radius, size)


def bounds(layout: Layout, queries: np.ndarray, metric: str) -> np.ndarray:
    """For every query and cell, a score that none of the cell's rows passes; empty cells have none."""
    centres, radius = layout.centres, layout.radius
    length = np.sqrt((queries**2).sum(axis=1))[:, None]
    if metric == "dot":
        top = queries @ centres.T + length * radius
        slack = length * (np.sqrt((centres**2).sum(axis=1)) + radius)
    else:
        far = np.sqrt(np.maximum(0, length**2 + (centres**2).sum(axis=1) - 2 * (queries @ centres.T)))
        # the product form of a distance is good to half the digits only
        top, slack = -np.maximum(0, far - radius), 1e3 * (length + np.sqrt((centres**2).sum(axis=1)) + radius)
    return np.where(layout.size > 0, top + _SLACK * slack + 1e-11, -np.inf)


def _first(order: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """How many of each query's cells, best first, it takes to hold ``k`` rows."""
    held = np.cumsum(size[order], axis=1)
    return np.minimum((held < k).sum(axis=1) + 1, (size > 0).sum())


def _asks(plain: Layout, queries: np.ndarray, metric: str, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each query's best cell, and by query and cell whether it is visited: the first cells or, given the ``least`` scores, the others not ruled out."""
    top = bounds(plain, queries, metric)
    order = np.argsort(-top, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    first = rank < _first(order, plain.size, k)[:, None]
    if least is not None:
        first = ~first & (top >= np.where(np.isnan(least), -np.inf, least)[:, None])
    return order[:, 0], first & (plain.size > 0)


def _visits(layout: Layout, metric: str, k: int, again: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``qid, v, cell, wanted, visits, least``: a query, its best cell, a bit for each cell that it visits, and their number.

    These are its first cells or, ``again``, the others that its ``least`` score (the third column) does not rule out.
    """
    plain = Layout(None, *layout)
    for batch in (whole.slice(part.start, part.stop - part.start) for whole in batches for part in slices(whole.num_rows, len(plain.size))):
        queries, rows = _vectors(batch.column(1), plain.width)
        if not len(rows):
            continue
        asked = pa.array(rows)
        least = batch.column(2).take(asked) if again else pa.nulls(len(rows), pa.float64())
        given = least.to_numpy(zero_copy_only=False).astype(float) if again else None
        cell, wanted = _asks(plain, queries, metric, k, given)
        bits = pa.array([w.tobytes() for w in np.packbits(wanted, axis=1)], pa.binary())
        n = pa.array(wanted.sum(axis=1).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(asked), batch.column(1).take(asked), pa.array(cell.astype(np.int32)), bits, n, least], ["qid", "v", "cell", "wanted", "visits", "least"]
        )


def _of_cell(numbers: np.ndarray) -> Column:
    """The cell's number out of a list with one for each cell."""
    return F.element_at(F.array(*[F.lit(int(x)) for x in numbers]), F.col("cell") + 1)


def _together(most: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of a task by ``cell``, at most ``most`` at once; less if ``PACKED_BYTES`` are waiting."""
    held, n = defaultdict(list), Counter()

    def full(cell: int) -> tuple[int, pa.Table]:
        n.pop(cell)
        return cell, pa.Table.from_batches(held.pop(cell)).combine_chunks()

    for batch in batches:
        cells = batch.column("cell").to_numpy()
        order = np.argsort(cells, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(cells[order])) + 1):
            for at in range(0, len(part), most):
                some, cell = part[at : at + most], int(cells[part[0]])
                if n[cell] + len(some) > most:
                    yield full(cell)
                held[cell].append(batch.take(pa.array(some)))
                n[cell] += len(some)
        while sum(n.values()) * width * 8 > PACKED_BYTES:
            yield full(max(n, key=n.get))
    for cell in list(n):
        yield full(cell)


def _list(column: pa.ChunkedArray) -> pa.ListArray:
    """One row that holds the whole column."""
    whole = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    return pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)


def _matrix(column: pa.ChunkedArray, width: int, kind: str) -> pa.Array:
    """One row that holds the vectors of a column, one after another."""
    return pa.array([_vectors(column, width)[0].astype(kind).tobytes()], pa.binary())


def _corpus_blocks(most: int, width: int, kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``cell, ids, v``: rows (``id, v, cell``) in blocks of one cell."""
    for cell, rows in _together(most, width, batches):
        yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), _list(rows["id"]), _matrix(rows["v"], width, kind)], ["cell", "ids", "v"])


_QUERY_BLOCK = ["block", "home", "qids", "asked", "least", "wanted", "visits"]


def _query_block(block: int, home: int, rows: pa.Table, n_cells: int, width: int, kind: str) -> list[pa.Array]:
    """A block of queries: for each cell that one of them visits, a bit for each query."""
    bits = np.frombuffer(b"".join(rows["wanted"].to_pylist()), np.uint8).reshape(rows.num_rows, -1)
    wanted = np.unpackbits(bits, axis=1, count=n_cells).T
    each = [np.packbits(w).tobytes() if w.any() else None for w in wanted]
    least = rows["least"].to_numpy().astype(float)
    floor = np.where(np.isnan(least), -np.inf, least)
    return [
        pa.array([block], pa.int64()), pa.array([home], pa.int32()), _list(rows["qid"]), _matrix(rows["v"], width, kind), pa.array([floor.tobytes()], pa.binary()),
        pa.array([each], pa.list_(pa.binary())), _list(rows["visits"]),
    ]


def _first_blocks(most: int, n_cells: int, width: int, kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Visits in blocks of queries with one best cell."""
    top = TaskContext.get().partitionId() << 32
    for at, (home, rows) in enumerate(_together(most, width, batches)):
        yield pa.RecordBatch.from_arrays(_query_block(top + at, home, rows, n_cells, width, kind), _QUERY_BLOCK)


def _other_blocks(plain: tuple, metric: str, k: int, kind: str, schema: pa.Schema, left: pa.Table, right: pa.Table) -> pa.Table:
    """The block of the queries ``left`` of a cell and piece, with their ``least`` scores (``right``) and the cells that these leave."""
    least = dict(zip(map(repr, right["qid"].to_pylist()), right["least"].to_pylist(), strict=True))  # an id may be a struct
    known = pa.array([least.get(repr(q)) for q in left["qid"].to_pylist()], pa.float64())
    batch = pa.RecordBatch.from_arrays([*(pa.concat_arrays(left[c].chunks) for c in ("qid", "v")), known], ["qid", "v", "least"]) if left.num_rows else None
    visits = [b.filter(pc.greater(b.column("visits"), 0)) for b in _visits(plain, metric, k, True, iter([batch]))] if batch else []
    if not sum(b.num_rows for b in visits):
        return schema.empty_table()
    home, piece = left["cell"][0].as_py(), left["piece"][0].as_py()
    rows = pa.Table.from_batches(visits)
    return pa.Table.from_arrays(_query_block((home << 32) + piece, home, rows, len(plain[2]), plain[0].shape[1], kind), schema=schema)


def _best(vectors: np.ndarray, queries: np.ndarray, k: int, metric: str, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``search.best_rows``; where few products reach their floor, these are all that is looked at."""
    if metric != "dot" or np.isneginf(floor).any():
        return best_rows(vectors, queries, k, metric, floor)
    found = []
    near = floor - 1e-11 - 1e-14 * np.abs(floor)
    for part in slices(len(queries), len(vectors)):
        scores = vectors @ queries[part].T
        rows, cols = np.divmod(np.flatnonzero(scores >= near[part]), scores.shape[1])
        if len(rows) > 4 * k * (part.stop - part.start):
            rows, cols, score = best_rows(vectors, queries[part], k, metric, floor[part])
        else:
            score = np.round(scores[rows, cols], SCORE_DIGITS)
            kept = score >= floor[part][cols]
            rows, cols, score = rows[kept], cols[kept], score[kept]
        found.append((rows, cols + part.start, score))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _merged(old: pd.DataFrame | None, found: pd.DataFrame, k: int, floor: np.ndarray) -> pd.DataFrame:
    """The ``k`` best of each query of a block; ``floor`` gets the ``k``-th score of the queries that have found more."""
    touched = np.zeros(len(floor), bool)
    touched[found["q"].to_numpy()] = True
    if old is not None:
        again = touched[old["q"].to_numpy()]
        old, found = old[~again], pd.concat([old[again], found])
    found = _k_best(found, k)
    filled = found.groupby("q")["score"].agg(["size", "min"])
    filled = filled[filled["size"] == k]
    at = filled.index.to_numpy(dtype=int)
    floor[at] = np.maximum(floor[at], filled["min"].to_numpy())
    return found if old is None else pd.concat([old, found])


def _met(k: int, metric: str, width: int, kinds: tuple[str, str], types: list[pa.DataType], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``home, qid, id, score``: of all pairs of blocks that a task sees, the ``k`` best rows of each query."""
    homes, names, floors, best = {}, {}, {}, {}
    for batch in batches:
        for at in range(batch.num_rows):
            row = {c: batch.column(c)[at] for c in batch.schema.names}
            block = row["block"].as_py()
            if block not in names:
                homes[block], names[block] = row["home"].as_py(), row["qids"].values.take(pa.array(range(len(row["qids"]))))  # not the batch
                floors[block] = np.frombuffer(row["least"].as_py(), float).copy()
            floor = floors[block]
            asks = np.flatnonzero(np.unpackbits(np.frombuffer(row["bits"].as_py(), np.uint8), count=len(floor)))
            queries = np.frombuffer(row["asked"].as_buffer(), kinds[1]).reshape(-1, width)[asks].astype(float)
            vectors = np.frombuffer(row["v"].as_buffer(), kinds[0]).reshape(-1, width).astype(float)
            ids = row["ids"].values.to_pandas().to_numpy()
            some, n = [], 0
            for part in slices(len(asks), len(vectors)):  # equal vectors tie, so a query may find the whole block
                rows, q, score = _best(vectors, queries[part], k, metric, floor[asks[part]])
                some.append(pd.DataFrame({"q": asks[part][q], "score": score, "id": ids[rows]}))
                n += len(rows)
                if n > SCORES_AT_ONCE or n and part.stop >= len(asks):
                    best[block] = _merged(best.get(block), pd.concat(some), k, floor)
                    some, n = [], 0
    sign = 1.0 if metric == "dot" else -1.0
    for block, rows in best.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(rows), homes[block], np.int32)), names[block].take(pa.array(rows["q"].to_numpy(np.int64))).cast(types[0]),
                pa.array(rows["id"].tolist(), types[1]), pa.array(rows["score"].to_numpy() * sign),
            ],
            ["home", "qid", "id", "score"],
        )


def _arrow_types(spark: SparkSession, *kinds: str) -> list[pa.DataType]:
    return [f.type for f in spark.createDataFrame([], ", ".join(f"c{k} {kind}" for k, kind in enumerate(kinds))).toArrow().schema]


def cell_search(
    queries: DataFrame, layout: Layout, k: int = 10, metric: str = "dot", qid: str = "qid", vec: str = "embedding"
) -> tuple[DataFrame, DataFrame]:
    """Hits (``qid, id, score, rank``) as ``search.knn`` gives them, and ``qid, visited, skipped``: cells by query.

    Queries of another length than the layout's vectors find nothing.
    """
    spark = layout.rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    numbers = _numbers(queries, vec)
    named = queries.select(F.col(qid).alias("qid"), F.col(vec).cast(numbers).alias("v")).filter("v IS NOT NULL")
    kind, id_kind = (t.schema[c].dataType.simpleString() for t, c in ((named, "qid"), (layout.rows, "id")))
    n, n_ids = named.agg(F.count(F.lit(1)), F.count_distinct(F.struct("qid"))).first()
    if n_ids < n:
        raise ValueError("query ids must be unique")
    plain = (layout.centres, layout.radius, layout.size)
    width, n_cells = layout.width, len(layout.size)
    stored = tuple("<f4" if t == "array<float>" else "<f8" for t in (layout.rows.schema["v"].dataType.simpleString(), numbers))
    few = max(1, BLOCK_BYTES // (8 * width))
    most_rows, most_queries = min(BLOCK_ROWS, few), min(BLOCK_QUERIES, few)
    types = _arrow_types(spark, kind, id_kind)

    def held(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        in_batches(df).write.option("parquet.block.size", 32 << 20).parquet(path)
        return spark.read.parquet(path)

    corpus = held(layout.rows.mapInArrow(partial(_corpus_blocks, most_rows, width, stored[0]), f"cell int, ids array<{id_kind}>, v binary"), "blocks")
    first = held(named.mapInArrow(partial(_visits, plain, metric, k, False), f"qid {kind}, v {numbers}, cell int, wanted binary, visits int, least double"), "visits")
    block = f"block long, home int, qids array<{kind}>, asked binary, least binary, wanted array<binary>, visits array<int>"

    def best(blocks: DataFrame, parts: int, tasks: int) -> DataFrame:
        """Every block of queries (in ``parts`` partitions) with all blocks of the cells that one of them visits, read in place."""
        shares = corpus.coalesce(max(1, -(-tasks * cores // max(1, parts))))
        bits = F.get("wanted", F.col("cell"))
        pairs = shares.join(blocks.drop("visits").hint("shuffle_replicate_nl"), bits.isNotNull()).select("block", "home", "qids", "asked", "least", bits.alias("bits"), "ids", "v")
        found = in_batches(pairs).mapInArrow(partial(_met, k, metric, width, stored, types), f"home int, qid {kind}, id {id_kind}, score double")
        return _ranked(found, k, ascending=not descending)

    descending = metric == "dot"
    asked = first.mapInArrow(partial(_first_blocks, most_queries, n_cells, width, stored[1]), block)
    found = held(best(asked, first.rdd.getNumPartitions(), FIRST_TASKS), "found")

    pieces = np.ones(n_cells, np.int64)
    for row in first.groupBy("cell").count().collect():  # one row for each cell
        pieces[row["cell"]] = -(-row["count"] // most_queries)
    parts = int(pieces.sum())
    dealt = lambda df: df.withColumn("piece", F.pmod(F.xxhash64("qid"), _of_cell(pieces))).repartition(parts, "cell", "piece").groupBy("cell", "piece")
    least = found.filter(F.col("rank") == k).select(F.col("home").alias("cell"), "qid", (F.col("score") if descending else -F.col("score")).alias("least"))
    schema = pa.schema(zip(_QUERY_BLOCK, [pa.int64(), pa.int32(), pa.list_(types[0]), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())], strict=True))
    others = dealt(first.select("qid", "v", "cell")).cogroup(dealt(least)).applyInArrow(partial(_other_blocks, plain, metric, k, stored[1], schema), block)
    every = found.select("qid", "id", "score").unionByName(best(others, parts, OTHER_TASKS).select("qid", "id", "score"))
    hits = _ranked(every, k, ascending=not descending).select("qid", "id", "score", "rank")
    again = others.select(F.explode(F.arrays_zip("qids", "visits")).alias("x")).select(F.col("x.qids").alias("qid"), F.col("x.visits").alias("visits"))
    counted = first.select("qid", "visits").unionByName(again).groupBy("qid").agg(F.sum("visits").alias("visited")).filter("visited > 0")
    visited = counted.select("qid", "visited", (F.lit(int((layout.size > 0).sum())) - F.col("visited")).alias("skipped"))
    return hits, visited
