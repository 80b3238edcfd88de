"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Base measures are counted for every document. The rules beyond the base are run
one after another, each only on the documents that passed all before it. Their
order is planned on a sample: every rule runs on all of the sample's rows, which
gives its cost in seconds and, from the joint pattern of rejections, how many of
the rows still alive it would reject. The next rule is the one that rejects most
per second. The order changes the work, never the verdict, which is that no rule
rejects.

Null text: an empty one, which fails the base. Repeated rows and ids: one result
per row. Empty table: no rows. Further columns are not looked at.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.tables import in_batches
from weftline.llm.words import Texts, chunks, combined

#: Fixed values of the base measures.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: One row of the planning sample in this many, by a hash of the id.
SAMPLE_ONE_IN = 50

#: Bytes of text measured at once; the measures of every byte and word take some forty times as much, and a worker keeps that room.
TEXT_AT_ONCE = 1 << 19

_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_ASCII_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122))
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_TAIL = (np.arange(256) & 0xC0) == 0x80
_CONTROL = (np.arange(256) < 32) & ~np.isin(np.arange(256), range(9, 14))


@dataclass
class Measured:
    """The rows of a chunk with what the base counts already hold."""

    texts: Texts
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_lines: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    word_row: np.ndarray
    word_print: np.ndarray

    @property
    def letters(self) -> np.ndarray:
        return np.maximum(self.texts.total(_ASCII_LETTER[self.texts.bytes]), 1)


def _seen_before(row: np.ndarray, print_: np.ndarray) -> np.ndarray:
    """Which entries equal an earlier one of the same row."""
    order = np.lexsort((print_, row))
    same = np.zeros(len(row), bool)
    a, b = order[1:], order[:-1]
    same[a] = (row[a] == row[b]) & (print_[a] == print_[b])
    return same


def measure(column: pa.Array) -> Measured:
    texts = Texts(column)
    raw = texts.bytes
    start, end, row = texts.words()
    prints = texts.fingerprints(start, end)
    heads = np.concatenate([[0], np.cumsum(~_TAIL[raw], dtype=np.int64)])
    n_words = texts.per_row(row)

    line_start, line_end, line_row = texts.spans(raw != 10)
    filled = texts.per_row(line_row)  # lines without any byte hold no word
    has_word = np.searchsorted(start, line_start) < np.searchsorted(start, line_end)
    line_start, line_end, line_row = line_start[has_word], line_end[has_word], line_row[has_word]
    again = _seen_before(line_row, texts.fingerprints(line_start, line_end))

    covered = np.zeros(len(row), bool)
    if len(row) >= 3:
        windows = combined(prints, 3)
        whole = row[:-2] == row[2:]
        places = np.flatnonzero(whole)
        order = places[np.lexsort((windows[places], row[places]))]
        a, b = order[1:], order[:-1]
        pair = (row[a] == row[b]) & (windows[a] == windows[b])
        twice = np.unique(np.concatenate([a[pair], b[pair]]))
        for k in range(3):
            covered[twice + k] = True
    return Measured(
        texts=texts,
        n_words=n_words,
        word_chars=texts.per_row(row, heads[end] - heads[start]),
        n_symbols=texts.total(_SYMBOL[raw]),
        n_lines=filled,
        n_dup_lines=texts.per_row(line_row[again]),
        n_repeat_words=texts.per_row(row[covered]),
        word_row=row,
        word_print=prints,
    )


def base_failed(m: Measured) -> np.ndarray:
    return (m.n_words < MIN_WORDS) | (100 * m.n_repeat_words > MAX_REPEAT_PERCENT * m.n_words)


# Each rule takes measured rows and says which of them it rejects.


def many_symbols(m: Measured) -> np.ndarray:
    return 10 * m.n_symbols > 3 * m.n_words


def word_length(m: Measured) -> np.ndarray:
    """Mean word below 2 or above 25 characters."""
    return (m.word_chars < 2 * m.n_words) | (m.word_chars > 25 * m.n_words)


def repeated_lines(m: Measured) -> np.ndarray:
    return 10 * m.n_dup_lines > 6 * m.n_lines


def shouting(m: Measured) -> np.ndarray:
    return 10 * m.texts.total(_UPPER[m.texts.bytes]) > 6 * m.letters


def exclamations(m: Measured) -> np.ndarray:
    return 10 * m.texts.total(m.texts.bytes == 33) > 3 * m.n_words


def mostly_digits(m: Measured) -> np.ndarray:
    return 2 * m.texts.total(_DIGIT[m.texts.bytes]) > m.word_chars


def control_bytes(m: Measured) -> np.ndarray:
    return 100 * m.texts.total(_CONTROL[m.texts.bytes]) > m.word_chars


def few_different_words(m: Measured) -> np.ndarray:
    """Under a twentieth of a short text's words are different; longer texts may repeat more."""
    again = m.texts.per_row(m.word_row[_seen_before(m.word_row, m.word_print)])
    return (m.n_words - again) * 20 < np.minimum(m.n_words, 2000)


Rule = Callable[[Measured], np.ndarray]
RULES: dict[str, Rule] = {
    f.__name__: f
    for f in (
        many_symbols, word_length, repeated_lines, shouting, exclamations, mostly_digits, control_bytes,
        few_different_words,
    )
}


def plan(patterns: dict[int, int], seconds: list[float]) -> list[int]:
    """Order rules by rejection per second among the rows that the chosen ones leave alive.

    ``patterns`` counts sample rows by the bits of the rules that reject them.
    Ties go to the cheaper rule, then to the earlier one.
    """
    left, chosen, alive = list(range(len(seconds))), [], dict(patterns)
    while left:
        def gain(k: int) -> tuple[float, float, int]:
            rejected = sum(n for bits, n in alive.items() if bits >> k & 1)
            return -rejected / max(seconds[k], 1e-9), seconds[k], k

        best = min(left, key=gain)
        chosen.append(best)
        left.remove(best)
        alive = {bits: n for bits, n in alive.items() if not bits >> best & 1}
    return chosen


def _trial(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text", TEXT_AT_ONCE):
            m = measure(part.column(0))
            bits, took = np.zeros(m.texts.n, np.int64), []
            for k, name in enumerate(names):
                began = time.perf_counter()
                bits |= RULES[name](m).astype(np.int64) << k
                took.append(time.perf_counter() - began)
            kinds, counts = np.unique(bits[~base_failed(m)], return_counts=True)
            n = len(kinds)
            yield pa.RecordBatch.from_pydict({
                "bits": pa.array(np.append(kinds, -1), pa.int64()),
                "n": pa.array(np.append(counts, 0), pa.int64()),
                "seconds": pa.array([[0.0] * len(names)] * n + [took], pa.list_(pa.float64())),
            })


def planned_order(docs: DataFrame, text: str, id_col: str, names: list[str], one_in: int) -> list[int]:
    """The cascade's order, from a hash sample; a summary of at most 2^rules rows reaches the driver."""
    rows = (
        in_batches(docs).filter(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(one_in)) == 0)
        .select(F.col(text).alias("text"))
        .mapInArrow(partial(_trial, names), "bits long, n long, seconds array<double>")
        .groupBy("bits")
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("seconds")[k]).alias(f"s{k}") for k in range(len(names))])
        .collect()
    )
    seconds = [sum(r[f"s{k}"] for r in rows) for k in range(len(names))]
    return plan({r["bits"]: r["n"] for r in rows if r["bits"] >= 0}, seconds)


def _judge(order: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text", TEXT_AT_ONCE):
            m = measure(part.column(1))
            failed = base_failed(m)
            alive, reason = np.flatnonzero(~failed), np.where(failed, "base", "").astype(object)
            view = m
            for name in order:
                if not len(alive):
                    break
                if len(alive) < view.texts.n:
                    view = _subset(part.column(1), m, alive)
                bad = RULES[name](view)
                reason[alive[bad]] = name
                alive = alive[~bad]
            yield pa.RecordBatch.from_arrays(
                [part.column(0)]
                + [pa.array(x, pa.int64()) for x in (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words)]
                + [pa.array(failed), pa.array(reason == ""), pa.array(reason, pa.string())],
                ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"],
            )


def _subset(column: pa.Array, m: Measured, alive: np.ndarray) -> Measured:
    """The rows still alive; what is left to look at shrinks with each rule that rejects many."""
    place = np.full(m.texts.n, -1)
    place[alive] = np.arange(len(alive))
    words = place[m.word_row] >= 0
    return Measured(
        texts=Texts(column.take(pa.array(alive))),
        word_row=place[m.word_row[words]],
        word_print=m.word_print[words],
        **{k: getattr(m, k)[alive] for k in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")},
    )


def quality_rules(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", rules: tuple[str, ...] = tuple(RULES),
    sample_one_in: int = SAMPLE_ONE_IN,
) -> DataFrame:
    """One row per row of ``docs``: the id, the base measures, ``base_failed``, ``kept`` and ``rejected_by``."""
    names = list(rules)
    order = [names[k] for k in planned_order(docs, text, id_col, names, sample_one_in)]
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        in_batches(docs).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
        .mapInArrow(
            partial(_judge, order),
            f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, kept boolean, rejected_by string",
        )
        .withColumnRenamed("id", id_col)
    )


def kept_documents(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged; the verdict is computed beside each row."""
    order = planned_order(docs, text, id_col, list(RULES), SAMPLE_ONE_IN)
    return in_batches(docs).mapInArrow(partial(_filter, [list(RULES)[k] for k in order], docs.columns.index(text)), docs.schema)


def _filter(order: list[str], place: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pair = pa.RecordBatch.from_arrays([batch.column(place), batch.column(place)], ["id", "text"])
        kept = [part.column(7) for part in _judge(order, iter([pair]))]
        if kept:
            yield batch.filter(pa.concat_arrays(kept))
