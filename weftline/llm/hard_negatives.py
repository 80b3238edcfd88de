"""Hard negatives by inner product, with coordinate pruning over length buckets.

In a pair of blocks the rows are cut into buckets of falling length, and every
bucket keeps a sorted list for each coordinate of its rows' directions. An anchor
that needs a score of at least ``t`` needs, in a bucket with the greatest length
``l``, a cosine of at least ``t / (|anchor| * l)``; that bounds every coordinate of
a direction from both sides. The anchor's ``FOCUS`` largest coordinates each give
such a range; the narrowest range is cut from its list, the others are intersected
with it, and what is left is scored exactly. Buckets that are too short for the
anchor are passed over, and where no range is narrow the whole bucket is scored.

Two passes over the blocks: the first finds each anchor's best rows of its own
label, its threshold rising from bucket to bucket; the second finds, for every
anchor and positive, the best rows of other labels between the two shares of the
positive's score. The bests of all pairs of blocks are merged by rank.

Components are scaled and rounded down to integers, and scores are integer inner
products, exact at any size (components and scores beyond 64 bits are held at the
ends of that range). Left out on both sides: null ids, null labels, vectors that
are null or hold null or non-finite numbers. Vectors of different lengths are zero
beyond their end. An anchor never meets a row with its own id. Rows that repeat id,
label and vector count once; an id with several labels or vectors stands for as
many anchors, each with its own positives. Ties go to the smaller id. A positive
with a negative score has no negatives, as its range is empty. Empty table: no
rows. Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.blocks import CANDIDATE_BLOCK, QUERY_BLOCK, dense, finite, meet
from weftline.llm.tables import kept

#: Rows of a bucket, and how many coordinates of an anchor are looked at.
BUCKET, FOCUS = 2048, 5

_ENDS = np.iinfo(np.int64)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows of ``a`` with rows of ``b``."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), _ENDS.min, _ENDS.max).astype(np.int64)


class Bucket:
    """Rows of like length: their directions and, for every coordinate, the sorted list of values."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, length: np.ndarray):
        self.rows, self.vectors, self.longest = rows, vectors, float(length.max())
        self.unit = vectors / np.where(length > 0, length, 1)[:, None]
        self.order = np.argsort(self.unit, axis=0)
        self.values = np.take_along_axis(self.unit, self.order, axis=0)

    def feasible(self, anchors: np.ndarray, reach: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Anchors that need every row, and the rows that are feasible for the others.

        ``anchors`` are directions, ``reach`` their lengths, ``least`` the scores they need.
        """
        n, width = self.unit.shape
        whole, some = least <= 0, {}
        top = reach * self.longest
        cosine = np.divide(least, top, out=np.full(len(least), 2.0), where=top > 0) * (1 - 1e-9)
        asked = np.flatnonzero(~whole & (cosine <= 1))
        if not len(asked):
            return np.flatnonzero(whole), some
        focus = np.argsort(-np.abs(anchors[asked]), axis=1)[:, : min(FOCUS, width)]
        q = np.take_along_axis(anchors[asked], focus, axis=1)
        c = cosine[asked][:, None]
        wide = np.sqrt(np.maximum(0, 1 - c**2)) * np.sqrt(np.maximum(0, 1 - q**2))
        low = np.where(-q >= c, -1.0, q * c - wide) - 1e-9
        high = np.where(q >= c, 1.0, q * c + wide) + 1e-9
        first, last = np.empty_like(focus), np.empty_like(focus)
        for f in np.unique(focus):
            own = focus == f
            first[own] = np.searchsorted(self.values[:, f], low[own], "left")
            last[own] = np.searchsorted(self.values[:, f], high[own], "right")
        size = last - first
        narrow = size.argmin(axis=1)
        for j, a in enumerate(asked):
            k = narrow[j]
            if 2 * size[j, k] > n:
                whole[a] = True
                continue
            found = self.order[first[j, k] : last[j, k], focus[j, k]]
            for i in range(focus.shape[1]):
                if i != k and size[j, i] < n:
                    x = self.unit[found, focus[j, i]]
                    found = found[(x >= low[j, i]) & (x <= high[j, i])]
            some[int(a)] = found
        return np.flatnonzero(whole), some


class Anchors:
    def __init__(self, vectors: np.ndarray):
        self.vectors, self.length = vectors, np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.unit = vectors / np.where(self.length > 0, self.length, 1)[:, None]


def buckets(vectors: np.ndarray, size: int) -> list[Bucket]:
    """The rows in buckets of falling length."""
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    return [Bucket(rows, vectors[rows], length[rows]) for rows in np.split(order, range(size, len(order), size)) if len(rows)]


def pruned(anchors: Anchors, parts: list[Bucket], least: Callable[[], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each bucket and anchor, rows and exact scores, among them all that reach ``least()``, which is asked for each bucket."""
    for part in parts:
        bound = least()
        whole, some = part.feasible(anchors.unit, anchors.length, bound)
        if len(whole):
            table = scores(anchors.vectors[whole], part.vectors)
            for a, line in zip(whole, table, strict=True):
                yield int(a), part.rows, line
        for a, found in some.items():
            if len(found):
                yield a, part.rows[found], scores(anchors.vectors[a : a + 1], part.vectors[found])[0]


def _positives(k: int, bucket: int, left: pa.Table, right: pa.Table) -> pa.Table:
    names = ["anchor", "positive_id", "positive_score"]
    found: list[tuple] = []
    if left.num_rows and right.num_rows:
        width, ids = _width(left, right), left["vec_id"].to_numpy()
        vectors, asked = dense(left["v"], width, np.int64), dense(right["v"], width, np.int64)
        places, own = _by_label(left), _by_label(right)
        anchor_ids, rows = right["vec_id"].to_numpy(), right["row"].to_numpy()
        for label, mine in own.items():
            if label not in places:
                continue
            here = places[label]
            anchors, low = Anchors(asked[mine]), np.full(len(mine), -np.inf)
            best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in mine]
            for a, at, score in pruned(anchors, buckets(vectors[here], bucket), lambda low=low: low.copy()):
                ok = (ids[here[at]] != anchor_ids[mine[a]]) & (score >= low[a])
                name, score = np.concatenate([best[a][0], ids[here[at[ok]]]]), np.concatenate([best[a][1], score[ok]])
                order = np.lexsort((name, -score.astype(object) if (score == _ENDS.min).any() else -score))[:k]
                best[a] = name[order], score[order]
                if len(order) == k:
                    low[a] = best[a][1][-1]
            found += [(np.full(len(n), rows[mine[a]]), n, s) for a, (n, s) in enumerate(best)]
    columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 3
    return pa.table([pa.array(c, pa.int64()) for c in columns], names)


def _negatives(k: int, low_share: int, high_share: int, bucket: int, left: pa.Table, right: pa.Table) -> pa.Table:
    names = ["anchor", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    found: list[tuple] = []
    if left.num_rows and right.num_rows:
        width, ids = _width(left, right), left["vec_id"].to_numpy()
        vectors, asked = dense(left["v"], width, np.int64), dense(right["v"], width, np.int64)
        labels = pd.factorize(np.concatenate([left["label"].to_numpy(), right["label"].to_numpy()]))[0]
        theirs, mine = labels[: len(ids)], labels[len(ids) :]
        anchor_ids, rows, pairs = right["vec_id"].to_numpy(), right["row"].to_numpy(), right["positives"].to_pylist()
        # 100 * low_share and the like pass 64 bits only for numbers of Python's own
        ranges = [[(-(-low_share * p["s"] // 100), high_share * p["s"] // 100) for p in own] for own in pairs]
        least = np.array([float(min((low for low, high in own if low <= high), default=np.inf)) for own in ranges])
        least -= np.abs(least) * 1e-12  # as a double it may stand above the integer
        at: list[list] = [[] for _ in pairs]
        for a, place, score in pruned(Anchors(asked), buckets(vectors, bucket), lambda: least):
            ok = (theirs[place] != mine[a]) & (score >= least[a]) & (ids[place] != anchor_ids[a])
            if ok.any():
                at[a].append((ids[place[ok]], score[ok]))
        for a, parts in enumerate(at):
            if not parts:
                continue
            name, score = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((name, score))  # ascending: the range's upper end is found by bisection
            name, score = name[order], score[order]
            for p, (low, high) in zip(pairs[a], ranges[a], strict=True):
                first, last = np.searchsorted(score, low, "left"), np.searchsorted(score, high, "right")
                if first < last:
                    # whole ties of the k-th best score, then the smaller ids
                    first = max(first, np.searchsorted(score, score[max(first, last - k)], "left"))
                    n, s = name[first:last], score[first:last]
                    take = np.lexsort((n, -s))[:k]
                    same = [np.full(len(take), x, np.int64) for x in (rows[a], anchor_ids[a], p["id"], p["s"])]
                    found.append((*same, n[take], s[take]))
    columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 6
    return pa.table([pa.array(c, pa.int64()) for c in columns], names)


def _width(*tables: pa.Table) -> int:
    return max(1, *(int(np.asarray(t["v"].combine_chunks().value_lengths()).max(initial=0)) for t in tables))


def _by_label(table: pa.Table) -> dict[str, np.ndarray]:
    return pd.Series(np.arange(table.num_rows)).groupby(table["label"].to_pandas().to_numpy()).indices


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
    n_positives: int = 5, n_negatives: int = 3, low_share: int = 50, high_share: int = 95, bucket: int = BUCKET,
    candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, scores in units of ``1 / scale`` squared.

    Anchors are the rows that ``is_anchor`` marks; a negative's score lies between
    ``low_share`` and ``high_share`` percent of its positive's.
    """
    rows = (
        vectors.select(
            F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("e"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        )
        .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("e"))
        .select("vec_id", "label", F.transform("e", lambda x: F.floor(x.cast("double") * scale)).alias("v"), "is_anchor")
        .groupBy("vec_id", "label", "v")
        .agg(F.max("is_anchor").alias("is_anchor"))
    )
    rows = kept(rows, "vectors").withColumn("row", F.xxhash64("vec_id", "label", "v"))
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    candidates, anchors = rows.select("row", "vec_id", "label", "v"), rows.filter("is_anchor").drop("is_anchor")
    spot = lambda: F.xxhash64("row", F.lit("block"))
    best = meet(
        candidates, anchors, n, n_anchors, spot, partial(_positives, n_positives, bucket),
        "anchor long, positive_id long, positive_score long", candidate_block, query_block,
    )
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    first = best.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n_positives)
    pairs = first.groupBy(F.col("anchor").alias("row")).agg(
        F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("s"))).alias("positives")  # n_positives at most
    )
    asked = kept(anchors.join(pairs, "row"), "anchors")
    found = meet(
        candidates, asked, n, n_anchors, spot, partial(_negatives, n_negatives, low_share, high_share, bucket),
        "anchor long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", candidate_block, query_block,
    )
    order = Window.partitionBy("anchor", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n_negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
