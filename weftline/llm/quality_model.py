"""A quality score from histogram gradient-boosted trees over document statistics.

Every whole text becomes a fixed list of numbers (``FEATURES``). Trees are grown
in numpy on histograms of binned numbers, level by level, for the logistic loss;
then all trees are laid out in flat arrays of one complete binary shape, so that
a batch of rows walks all trees at once with array look-ups.

The model is fitted on about ``max_rows`` labelled rows, twice as many at most,
chosen by a hash of the id and, where ids have many rows, of their numbers. Rows
that repeat id, numbers and label are one there. Only their numbers, not their
texts, reach the driver.

Null text: an empty one, with all numbers 0. Repeated rows: one score each.
Rows with the same id and other labels all count. Null labels are left out.
Without any usable label the score is 0.5. Empty table: no rows. Further columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.quality_rules import _ASCII_LETTER, _CONTROL, _DIGIT, _UPPER, measure
from weftline.llm.words import chunks
from weftline.storage import cut, scratch_path

FEATURES = (
    "words", "word_chars", "symbols", "lines", "repeated_lines", "repeated_windows", "upper", "ascii_letters",
    "digits", "exclamations", "full_stops", "commas", "bars", "hyphens", "quotes", "brackets", "control", "above_ascii",
    "blank", "different_words", "short_words", "long_words", "word_spread", "title_words", "line_words", "same_neighbours",
)

#: Bounded sample of labelled rows for fitting, and the shape of the trees.
MAX_ROWS, BINS, DEPTH, TREES, RATE, L2, LEAST = 20_000, 64, 4, 80, 0.15, 1.0, 10


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text: shares of its words, characters or lines."""
    m = measure(column)
    texts, raw, n = m.texts, m.texts.bytes, m.texts.n
    words, chars = np.maximum(m.n_words, 1), np.maximum(m.word_chars, 1)
    start, end, row = texts.words()
    size = (end - start).astype(float)
    mean = texts.per_row(row, size) / words
    again = np.zeros(len(row), bool)
    order = np.lexsort((m.word_print, row))
    a, b = order[1:], order[:-1]
    again[a] = (row[a] == row[b]) & (m.word_print[a] == m.word_print[b])
    neighbours = np.zeros(len(row), bool)
    neighbours[1:] = (row[1:] == row[:-1]) & (m.word_print[1:] == m.word_print[:-1])

    def share(of: str) -> np.ndarray:
        return texts.total(np.isin(np.arange(256), [ord(c) for c in of])[raw]) / words

    cells = [
        np.log1p(m.n_words), m.word_chars / words, m.n_symbols / words, m.n_lines / words,
        m.n_dup_lines / np.maximum(m.n_lines, 1), m.n_repeat_words / words,
        texts.total(_UPPER[raw]) / np.maximum(texts.total(_ASCII_LETTER[raw]), 1), texts.total(_ASCII_LETTER[raw]) / chars,
        texts.total(_DIGIT[raw]) / chars, share("!"), share("."), share(","), share("|"), share("-_"), share("\"'"),
        share("()[]{}"), texts.total(_CONTROL[raw]) / chars, texts.total(raw > 127) / chars,
        1 - texts.per_row(row, size) / np.maximum(np.diff(texts.starts), 1),
        1 - texts.per_row(row[again]) / words, texts.per_row(row[size <= 2]) / words, texts.per_row(row[size >= 12]) / words,
        np.sqrt(np.maximum(texts.per_row(row, size * size) / words - mean * mean, 0)),
        texts.per_row(row[_UPPER[raw[start]]]) / words, m.n_words / np.maximum(m.n_lines, 1),
        texts.per_row(row[neighbours]) / words,
    ]
    out = np.stack(cells, 1)
    out[m.n_words == 0] = 0
    return out.reshape(n, len(FEATURES)).astype(np.float32)


def _as_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            cells = pa.array(statistics(part.column(1)).ravel())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.FixedSizeListArray.from_arrays(cells, len(FEATURES)).cast(pa.list_(pa.float32()))],
                ["id", "stats"],
            )


class Forest:
    """Complete binary trees as flat arrays: node ``k`` has the children ``2k+1`` and ``2k+2``."""

    def __init__(self, base: float, depth: int):
        self.base, self.depth = base, depth
        self.feature: np.ndarray = np.zeros((0, 2**depth - 1), np.int32)
        self.cut: np.ndarray = np.zeros((0, 2**depth - 1), np.float32)
        self.leaf: np.ndarray = np.zeros((0, 2**depth), np.float64)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Chance of label 1 for every row; all trees are walked side by side."""
        trees, inner = np.arange(len(self.leaf)), 2**self.depth - 1
        total = np.full(len(x), self.base)
        if len(trees) == 0:
            return 1 / (1 + np.exp(-total))
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(trees)), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.cut[trees, node])
            total[at : at + 4096] += self.leaf[trees, node - inner].sum(1)
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE,
    l2: float = L2, least: int = LEAST,
) -> Forest:
    """Boost ``trees`` histogram trees for the logistic loss; a pure or empty sample gives no tree."""
    chance = (y.sum() + 1) / (len(y) + 2)
    forest = Forest(float(np.log(chance / (1 - chance))) if len(y) else 0.0, depth)
    if len(y) == 0 or y.min() == y.max():
        return forest
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])).astype(np.float32) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    n_features = len(edges)
    score = np.full(len(y), forest.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        feature = np.zeros(2**depth - 1, np.int32)
        cut = np.full(2**depth - 1, np.inf, np.float32)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            place = (node - first) * bins
            size = width * bins
            hist = np.empty((3, n_features, width, bins))
            for f in range(n_features):
                key = place + binned[f]
                for k, w in enumerate((grad, hess, None)):
                    hist[k, f] = np.bincount(key, w, size).reshape(width, bins)
            left = hist.cumsum(3)
            total = left[..., -1:]
            right = total - left
            gain = left[0] ** 2 / (left[1] + l2) + right[0] ** 2 / (right[1] + l2) - total[0] ** 2 / (total[1] + l2)
            gain[(left[2] < least) | (right[2] < least)] = 0
            for f in range(n_features):
                gain[f, :, len(edges[f]) :] = 0
            flat = gain.transpose(1, 0, 2).reshape(width, -1)
            best = flat.argmax(1)
            for j in np.flatnonzero(flat.max(1) > 1e-6):
                f, b = divmod(int(best[j]), bins)
                feature[first + j], cut[first + j] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        spot = node - (2**depth - 1)
        g, h = np.bincount(spot, grad, 2**depth), np.bincount(spot, hess, 2**depth)
        leaf = -rate * g / (h + l2)
        score += leaf[spot]
        forest.feature = np.vstack([forest.feature, feature])
        forest.cut = np.vstack([forest.cut, cut])
        forest.leaf = np.vstack([forest.leaf, leaf])
    return forest


def _scored(forest: Forest, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats = batch.column(1)
        x = np.asarray(stats.flatten(), np.float32).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forest.scores(x), pa.float64())], ["id", "score"])


def document_statistics(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id`` and ``stats`` of every row, one pass over the texts."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(
        _as_batches, f"id {kind}, stats array<float>"
    )


def quality_scores(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``id_col`` and ``score`` for every row of ``docs``; ``labels`` holds what may be learnt from."""
    spark = docs.sparkSession
    kept = scratch_path(spark, "statistics")
    document_statistics(docs, text, id_col).write.parquet(kept)
    stats = spark.read.parquet(kept)
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")
    ).distinct()
    total = known.count()
    spot = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 40))
    if total > max_rows:  # a hash share of the rows, so that about max_rows are left
        known = known.filter(spot < int((1 << 40) * max_rows / total))
    # An id may have any number of rows: equal ones are one, and of different ones a hash share is taken too.
    drawn = cut(stats.join(F.broadcast(known), "id").select("id", "stats", "y").distinct())
    rows = drawn.count()
    if rows > 2 * max_rows:
        drawn = drawn.filter(F.pmod(F.xxhash64("id", "stats", "y"), F.lit(1 << 40)) < int((1 << 40) * max_rows / rows))
    sample = drawn.toPandas()
    sample = sample.sort_values(["id", "y"], kind="stable")
    x = np.stack(sample["stats"]).astype(np.float32) if len(sample) else np.zeros((0, len(FEATURES)), np.float32)
    forest = fit(x, sample["y"].to_numpy(float))
    kind = docs.schema[id_col].dataType.simpleString()
    return stats.mapInArrow(partial(_scored, forest), f"id {kind}, score double").withColumnRenamed("id", id_col)
