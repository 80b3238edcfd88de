"""Phrase collocations, mined by SON partitioning.

Everything is per language. A phrase is a run of words inside a piece of a text; a
candidate is one of 2 to ``longest`` words that occurs ``min_count`` times or more.

* **Shards.** A shard is a run of rows of one task with at most about
  ``shard_bytes`` of text (a row at least). A shard with the share ``w`` of all
  text is mined completely, by word fingerprints and length after length, at the
  local support ``t = ceil(min_count * w)``, or ``MOST_LOCAL`` if that is less. The
  shares add up to one, so a phrase that stays below ``t`` in every shard occurs
  less than ``min_count`` times.
* **Union.** A phrase that a shard reports with ``c`` occurrences can have ``t - 1``
  in each shard that does not report it, and no more. Phrases whose sum of
  ``c - (t - 1)`` and of ``t - 1`` over all shards stays below ``min_count`` go.
* **Exact counts.** The fingerprints of the others are marked in a bit table of
  fixed size, the one thing that is broadcast. A second reading counts every
  occurrence of a marked phrase; a chance mark costs a row and changes no count.
  Sums are made per task, over a bounded number of phrases at a time, before the
  shuffle.
* **Two rounds.** Words and pairs first; longer phrases are then mined only where
  all their pairs are frequent in the whole table.

Phrases are told apart by 64-bit fingerprints within a task and by their words
between tasks. Scores are exact: products are made in decimals of 38 places.

Null text: an empty one. Null language: ``und``. Words are compared as bytes after
A-Z are lower-cased; whole texts are read, however long. Repeated rows count each.
Ties go to the phrase that comes first in UTF-8 byte order. Empty table, or nothing
frequent: no rows. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.tables import kept
from weftline.llm.words import Texts, chunks, mixed

MIN_COUNT, TOP, LONGEST, COVERED = 100, 2000, 5, 100

#: Text of a shard, the greatest local support, and the size of the bit table (8 MB).
SHARD_BYTES, MOST_LOCAL, TABLE_BITS = 16 << 20, 2, 26

#: Phrases that a task holds while it counts (few more, by the shard), and the most text that it reads then.
MOST_HELD, TASK_BYTES = 400_000, 1 << 30

#: What ends a piece, and what stands between words.
ENDS, BLANKS = b".,;:!?\n\v\f\r", b" \t"

_END, _SEPARATOR = np.zeros(256, bool), np.zeros(256, bool)
_END[list(ENDS)] = True
_SEPARATOR[list(ENDS + BLANKS)] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORDS = re.compile(rb"[^ \t.,;:!?\n\v\f\r]+")
_SLICE, _RANGES = 1 << 18, 8


class Shard:
    """Words of some rows: fingerprints, languages and whether the next word stands in the same piece."""

    def __init__(self, with_text: bool):
        self.with_text, self.size, self.names, self.parts, self.pieces = with_text, 0, {}, [], []

    def add(self, rows: pa.RecordBatch) -> None:
        texts = Texts(rows.column(1), lower=True)
        start, end, row = texts.spans(~_SEPARATOR[texts.bytes])
        ends = np.concatenate([[0], np.cumsum(_END[texts.bytes], dtype=np.uint32)])
        follows = np.zeros(len(start), bool)
        follows[:-1] = (row[1:] == row[:-1]) & (ends[start[1:]] == ends[end[:-1]])
        codes = np.array([self.names.setdefault(x, len(self.names)) for x in rows.column(0).to_pylist()])
        codes = codes.astype(np.uint16 if len(self.names) < 1 << 16 else np.uint32)
        place = [(start + self.size).astype(np.uint32)] if self.with_text else []
        self.parts.append([texts.fingerprints(start, end), codes[row], follows, *place])
        if self.with_text:
            self.pieces.append(texts.bytes.tobytes())
        self.size += len(texts.bytes)

    def close(self) -> Shard:
        columns, self.parts = list(zip(*self.parts, strict=True)), []
        self.words, self.lang, self.follows, *place = (np.concatenate(columns.pop(0)) for _ in range(len(columns)))
        if place:
            self.start = np.append(place[0], np.uint32(self.size))
            self.text, self.pieces = b"".join(self.pieces), []
        seeds = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in self.names]
        self.seeds = np.array(seeds, np.uint64)
        return self

    def keys(self, at: np.ndarray, n: int, old: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Keys of the runs of ``n`` words at ``at`` from those of the runs that are a word shorter, at ``old``."""
        out = np.empty(len(at), np.uint64)
        for k in range(0, len(at), _SLICE):  # by slices: no passing array is as long as the shard
            part = slice(k, k + _SLICE)
            word = self.words[at[part] + np.uint32(n - 1)]
            if n == 1:
                out[part] = mixed(word ^ self.seeds[self.lang[at[part]]])
            else:
                out[part] = mixed(shorter[np.searchsorted(old, at[part])] * _STEP + word)
        return out

    def phrase(self, at: int, n: int) -> str:
        return b" ".join(_WORDS.findall(self.text, int(self.start[at]), int(self.start[at + n]))).decode()


def shards(batches: Iterable[pa.RecordBatch], shard_bytes: int, with_text: bool) -> Iterator[Shard]:
    shard = Shard(with_text)
    for batch in batches:
        for part in chunks(batch, batch.schema.names[1], min(1 << 20, shard_bytes)):
            if shard.size and shard.size + part.column(1).nbytes > shard_bytes:
                yield shard.close()
                shard = Shard(with_text)  # the last one is let go before the next one grows
            shard.add(part)
    if shard.parts:
        yield shard.close()


def marked(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys' bits are set."""
    out = np.empty(len(keys), bool)
    for k in range(0, len(keys), _SLICE):
        bit = keys[k : k + _SLICE] >> np.uint64(64 - 6 - int(np.log2(len(table))))
        out[k : k + _SLICE] = table[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)
    return out


def runs(shard: Shard, lengths: tuple[int, ...], pairs: np.ndarray | None, chosen) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``n``, places and keys of the phrases of each length that ``chosen(places, keys)`` keeps.

    Of a longer phrase both parts that are a word shorter must have been kept; ``pairs`` is the bit
    table that decides on those before the first length.
    """
    size = len(shard.words)
    at, keys, inside = np.empty(0, np.uint32), np.empty(0, np.uint64), np.ones(size, bool)
    for n in range(1, max(lengths) + 1):
        old = at
        if n > 1:  # a run goes on where the run at the next word was kept too
            both = inside[:-1] & inside[1:]
            at = np.flatnonzero(both & shard.follows[:-1] if n == 2 else both).astype(np.uint32)
        else:
            at = np.arange(size, dtype=np.uint32)
        keys = shard.keys(at, n, old, keys)
        if n in lengths:
            keep = chosen(at, keys)
        else:
            keep = marked(pairs, keys) if n == 2 else np.ones(len(at), bool)
        at, keys = at[keep], keys[keep]
        inside = np.zeros(size, bool)
        inside[at] = True
        if n in lengths:
            yield n, at, keys


def _groups(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Equal keys side by side: their places, where in these each key begins, and its count; one range of keys at a time."""
    shift = np.uint64(64 - int(np.log2(_RANGES)))
    part = np.empty(len(keys), np.uint8)
    for k in range(0, len(keys), _SLICE):
        part[k : k + _SLICE] = keys[k : k + _SLICE] >> shift
    for r in range(_RANGES):
        order = np.flatnonzero(part == r).astype(np.uint32)
        own = keys[order]
        turn = np.argsort(own, kind="stable")
        order, own = order[turn], own[turn]
        fresh = np.ones(len(own), bool)
        fresh[1:] = own[1:] != own[:-1]
        heads = np.flatnonzero(fresh)
        yield order, heads, np.diff(np.append(heads, len(own)))


def frequent(shard: Shard, least: int, lengths: tuple[int, ...], pairs: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``n``, first places, keys and counts of all phrases with ``least`` occurrences in the shard."""
    found: list[np.ndarray] = []

    def chosen(at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        keep, parts = np.zeros(len(keys), bool), []
        for order, heads, count in _groups(keys):
            enough = count >= least
            first = order[heads[enough]]
            parts.append((at[first], keys[first], count[enough]))
            keep[order[np.repeat(enough, count)]] = True
        found[:] = [np.concatenate(x) for x in zip(*parts, strict=True)]
        return keep

    for n, _, _ in runs(shard, lengths, pairs, chosen):
        yield n, *found


def _mine(total: int, min_count: int, most_local: int, shard_bytes: int, lengths: tuple[int, ...], pairs, batches) -> Iterator[pa.RecordBatch]:
    """``key, excess`` of what each shard reports; the row with a null key has what the shard may leave unreported."""
    for shard in shards(batches, shard_bytes, False):
        least = max(1, min(most_local, -(-min_count * shard.size // total)))
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([least - 1], pa.int64())], ["key", "excess"])
        for _, _, keys, count in frequent(shard, least, lengths, pairs and pairs.value):
            for k in range(0, len(keys), 1 << 16):
                part = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), pa.array(count[part] - (least - 1))], ["key", "excess"])
        shard = keys = count = None


class Held:
    """Counts of the phrases that a task has met, each with its words."""

    def __init__(self):
        self.slots: dict[int, int] = {}
        self.counts = np.zeros(0, np.int64)
        self.langs, self.phrases, self.lengths = [], [], []

    def add(self, shard: Shard, n: int, keys: np.ndarray, at: np.ndarray, count: np.ndarray) -> None:
        """``keys`` are different from each other; the words of a new one are read at its place."""
        slots, names, size = self.slots, list(shard.names), len(self.slots)
        spot = np.array([slots.setdefault(k, len(slots)) for k in keys.tolist()], np.int64)
        for i in at[spot >= size].tolist():
            self.phrases.append(shard.phrase(i, n))
            self.langs.append(names[shard.lang[i]])
        self.lengths += [n] * (len(slots) - size)
        if len(slots) > len(self.counts):
            self.counts = np.append(self.counts, np.zeros(len(slots), np.int64))
        self.counts[spot] += count

    def batch(self) -> pa.RecordBatch:
        keys = np.fromiter(self.slots, np.uint64, len(self.slots))
        columns = [
            pa.array(self.langs, pa.string()), pa.array(self.phrases, pa.string()), pa.array(self.lengths, pa.int32()),
            pa.array(keys.view(np.int64)), pa.array(self.counts[: len(keys)]),
        ]
        return pa.RecordBatch.from_arrays(columns, _COUNTED)


_COUNTED = ["lang", "phrase", "n", "key", "count"]


def _count(shard_bytes: int, most_held: int, lengths: tuple[int, ...], wanted, pairs, batches) -> Iterator[pa.RecordBatch]:
    """``lang, phrase, n, key, count`` of the marked phrases of a task; null phrases have the words of a language.

    Counts are summed up over the shards of the task, and passed on when ``most_held`` phrases are held.
    """
    held = Held()
    for shard in shards(batches, shard_bytes, True):
        if 1 in lengths:
            langs = pa.array(list(shard.names), pa.string())
            words = np.bincount(shard.lang, minlength=len(langs))
            none = [pa.nulls(len(langs), t) for t in (pa.string(), pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays([langs, *none, pa.array(words)], _COUNTED)
        for n, at, keys in runs(shard, lengths, pairs and pairs.value, lambda _, keys: marked(wanted.value, keys)):
            for order, heads, count in _groups(keys):
                first = order[heads]
                held.add(shard, n, keys[first], at[first], count)
                if len(held.slots) >= most_held:
                    yield held.batch()
                    held = Held()
        shard = at = keys = order = heads = count = first = None
    yield held.batch()


def bit_table(keys: DataFrame, bits: int = TABLE_BITS):
    """A broadcast bit table with the marks of ``key``; at most ``2 ** (bits - 6)`` numbers reach the driver."""
    bit = F.shiftrightunsigned("key", 64 - bits)
    words = keys.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 63 as int))").alias("mark"))
    found = words.groupBy("word").agg(F.bit_or("mark").alias("mark")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[found["word"].to_numpy()] = found["mark"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table)


def counted(
    rows: DataFrame, total: int, lengths: tuple[int, ...], pairs=None, min_count: int = MIN_COUNT, shard_bytes: int = SHARD_BYTES,
    most_local: int = MOST_LOCAL, table_bits: int = TABLE_BITS,
) -> DataFrame:
    """``lang, phrase, n, key, f`` of all phrases of these lengths with ``min_count`` occurrences; null phrases have the words of a language."""
    reports = rows.mapInArrow(partial(_mine, total, min_count, most_local, shard_bytes, lengths, pairs), "key long, excess long")
    sums = kept(reports.groupBy("key").agg(F.sum("excess").alias("excess")), "reported")
    slack = sums.filter("key is null").agg(F.sum("excess")).first()[0] or 0
    wanted = bit_table(sums.filter(F.col("key").isNotNull() & (F.col("excess") + slack >= min_count)), table_bits)
    # Two tasks for each core: the more text a task reads, the fewer of its counts meet others of the same phrase.
    few = rows.coalesce(max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES)))
    found = few.mapInArrow(partial(_count, shard_bytes, MOST_HELD, lengths, wanted, pairs), "lang string, phrase string, n int, key long, count long")
    exact = found.groupBy("lang", "phrase").agg(F.max("n").alias("n"), F.max("key").alias("key"), F.sum("count").alias("f"))
    return kept(exact.filter(F.col("phrase").isNull() | (F.col("f") >= min_count)), "counted")


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST,
    shard_bytes: int = SHARD_BYTES, most_local: int = MOST_LOCAL, table_bits: int = TABLE_BITS,
) -> DataFrame:
    """``lang, phrase, n, f``: all words and phrases with ``min_count`` occurrences; the null phrase of a language has all its words."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    options = {"min_count": min_count, "shard_bytes": shard_bytes, "most_local": most_local, "table_bits": table_bits}
    short = counted(rows, total, tuple(range(1, min(longest, 2) + 1)), **options)
    if longest <= 2:
        return short.drop("key")
    pairs = bit_table(short.filter("n = 2"), table_bits)
    return short.union(counted(rows, total, tuple(range(3, longest + 1)), pairs, **options)).drop("key")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, longest: int = LONGEST,
    covered: int = COVERED, shard_bytes: int = SHARD_BYTES, most_local: int = MOST_LOCAL, table_bits: int = TABLE_BITS,
) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase inside a longer one that has ``covered`` percent of its occurrences or more is left out.
    """
    counts = phrase_counts(docs, text, lang, min_count, longest, shard_bytes, most_local, table_bits)
    known = counts.filter("phrase is not null")
    words = counts.filter("phrase is null").select("lang", F.col("f").alias("n"))
    several = known.filter("n > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    part = lambda first, size: F.array_join(F.slice("w", first, size), " ")
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(1, F.col("k")).alias("left"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    side = lambda name, f: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(f)).hint("merge")
    # 1000 * a fits 64 bits for any count below 9 * 10 ** 15, its product with n and l * r fit 38 places
    whole = "cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(18,0)))"
    scored = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).join(words, "lang")
    lowest = F.min(F.struct(F.expr(whole).alias("score"), "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(lowest)
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("w") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda at: F.array_join(F.slice("w", at, size), " ")),
        )
    )
    inside = several.filter(F.size("w") > 2).select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = best.join(inside.hint("merge"), ["lang", "phrase"], "left").filter(F.coalesce(F.lit(100) * F.col("longer") < F.lit(covered) * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
