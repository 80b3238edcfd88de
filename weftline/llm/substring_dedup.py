"""Repeated passages by FM-index: words covered by a window that also starts in a document with a smaller id.

* **Segments.** Every window of ``window`` words has a key, the smallest
  fingerprint of its ``KEY_WORDS``-word runs; neighbouring windows mostly share
  it and form a segment. Equal windows have equal keys, wherever they stand, so
  documents only have to meet where they share a key, and a key of one document
  ends there. Equal segments of all documents are one, with the smallest id.
* **Shards.** Keys that are left are dealt to shards of bounded size. A key with
  very many different segments (a common passage with a different neighbourhood
  in every document) is dealt further, window by window, by the window's first
  and last word.
* **FM-index.** A shard's segments become one text over its own word numbers,
  with its Burrows-Wheeler transform in a wavelet matrix (packed bits with counts
  per 64). The segments are then streamed through it from right to left by
  backward search: the suffix interval is extended by each word and, at
  ``window`` words, reported with the smallest document in the interval and cut
  back by its last word. That gives the matching statistics up to ``window``.

The decision compares 64-bit fingerprints of words. Null text: no words. Rows
with a null id neither lose words nor make others lose any. Rows with one id do
not remove each other's words; repeated rows get one result each. Texts below
``window`` words keep all. Empty table: no rows. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.tables import in_batches, kept
from weftline.llm.words import Texts, chunks, combined, mixed

KEY_WORDS = 8

#: Windows of one segment, words of one shard, and different segments of a key before it is dealt further.
SEGMENT_WINDOWS, SHARD_WORDS, WIDE_KEY = 128, 300_000, 2_000

#: Bytes of pieces that a worker holds and sends at once; the windows of a wide segment are many times its words.
PIECES_AT_ONCE = 2 << 20

_ODD = 0x9E3779B97F4A7C15
_ODD_BACK = pow(_ODD, -1, 2**64)

_SEGMENTS = "id long, key long, start int, words int, dealt long, print long"


def _windows_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _segments(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            texts = Texts(part.column(1))
            start, end, row = texts.words()
            if len(row) < window:
                continue
            prints = texts.fingerprints(start, end)
            least = _windows_least(combined(prints, KEY_WORDS), window - KEY_WORDS + 1)
            inside = row[: len(least)] == row[window - 1 :]
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
            at = np.flatnonzero(inside)
            if not len(at):
                continue
            head = at[new[at]]
            # long runs are cut; both parts keep the key
            since = at - head[np.searchsorted(head, at, "right") - 1]
            first = at[since % SEGMENT_WINDOWS == 0]
            size = np.bincount(np.searchsorted(first, at, "right") - 1, minlength=len(first))
            last = first + size + window - 1  # behind the segment's last word
            upto = np.zeros(len(prints) + 1, np.uint64)
            power, back = (np.full(len(prints) + 1, p, np.uint64) for p in (_ODD, _ODD_BACK))
            power[0] = back[0] = 1
            power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
            np.cumsum(prints * power[:-1], out=upto[1:])
            moved = (upto[last] - upto[first]) * back[first]  # the same words, the same sum, wherever they stand
            named = mixed(moved ^ (last - first).astype(np.uint64))
            begin = np.searchsorted(row, np.arange(texts.n))
            of = row[first]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(of)), part.column(2).take(pa.array(of)),
                    pa.array((first - begin[of]).astype(np.int32)), pa.array((last - first).astype(np.int32)),
                    pa.array(least[first].view(np.int64)), pa.array(named.view(np.int64)),
                ],
                ["id", "key", "start", "words", "dealt", "print"],
            )


_PIECES = "dealt long, print long, at int, spot long, piece long, least long, most long, words binary"


def _pieces(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the segments that a text holds for all others; wide ones window by window."""
    for batch in batches:
        for part in chunks(batch, "text"):
            texts = Texts(part.column(0))
            start, end, row = texts.words()
            prints = texts.fingerprints(start, end)
            begin = np.searchsorted(row, np.arange(texts.n))
            rows: list[tuple] = []
            held = 0
            for k, segments in enumerate(part.column(1)):
                for s in segments.as_py():
                    words = prints[begin[k] + s["start"] : begin[k] + s["start"] + s["words"]]
                    if not s["wide"]:
                        rows.append((s["dealt"], s["print"], 0, s["dealt"], s["print"], s["least"], s["most"], words.tobytes()))
                        held += words.nbytes
                    else:
                        names = combined(words, window).view(np.int64)
                        spots = mixed(mixed(words[: len(names)]) + words[window - 1 :]).view(np.int64)
                        for at in range(len(names)):
                            piece = words[at : at + window].tobytes()
                            rows.append((s["dealt"], s["print"], at, int(spots[at]), int(names[at]), s["least"], s["most"], piece))
                        held += len(names) * window * words.itemsize
                    if held >= PIECES_AT_ONCE:
                        yield _batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield _batch_of(rows)


def _batch_of(pieces: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pandas(pd.DataFrame(pieces, columns=[c.split()[0] for c in _PIECES.split(", ")]).astype(
        {"dealt": "int64", "print": "int64", "at": "int32", "spot": "int64", "piece": "int64", "least": "int64", "most": "int64"}
    ), preserve_index=False)


class WaveletMatrix:
    """Rank queries over a sequence of numbers, a packed bit row with counts per 64 for each bit."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        n = len(sequence)
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (sequence >> bit) & 1 == 1
            packed = np.zeros(-(-(n + 1) // 64) * 8, np.uint8)
            packed[: -(-n // 8)] = np.packbits(ones, bitorder="little")
            packed = packed.view(np.uint64)
            upto = np.concatenate([[0], np.cumsum(np.bitwise_count(packed))]).astype(np.uint32)
            self.levels.append((bit, packed, upto, n - int(ones.sum())))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])
        self.first = self._descend(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _descend(self, value: np.ndarray, place: np.ndarray) -> np.ndarray:
        for bit, packed, upto, zeros in self.levels:
            word = place >> 6
            low = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = upto[word].astype(np.int64) + np.bitwise_count(packed[word] & low)
            place = np.where((value >> bit) & 1, zeros + ones, place - ones)
        return place

    def rank(self, value: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each value stands before each place."""
        return self._descend(value, place) - self.first[value]


class FMIndex:
    """An index of word sequences for patterns of exactly up to ``window`` words."""

    def __init__(self, pieces: list[np.ndarray], documents: np.ndarray, window: int):
        sizes = np.array([len(p) for p in pieces])
        self.start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        self.sizes, self.window = sizes, window
        alphabet, numbers = np.unique(np.concatenate(pieces), return_inverse=True)
        self.text = np.zeros(int(sizes.sum()) + len(pieces), np.int64)  # 0 stands behind each piece
        owner = np.repeat(np.arange(len(pieces)), sizes + 1)
        filled = np.ones(len(self.text), bool)
        filled[self.start + sizes] = False
        self.text[filled] = numbers + 1
        n = len(self.text)

        def shifted(rank: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros(n, np.int64)
            if by < n:
                out[: n - by] = rank[by:] + 1
            return out

        def joined(rank: np.ndarray, by: int) -> np.ndarray:
            return np.unique(rank * (n + 2) + shifted(rank, by), return_inverse=True)[1]

        half, rank = 1, self.text
        while half * 2 < window:  # ranks by the first 1, 2, 4, ... words
            rank, half = joined(rank, half), half * 2
        whole, shorter = joined(rank, window - half), joined(rank, window - 1 - half)
        order = np.argsort(whole, kind="stable")
        before = self.text[order - 1]
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=len(alphabet) + 1))])
        self.bits = WaveletMatrix(before, len(alphabet))
        flags = np.ones(n, bool)
        flags[1:] = np.diff(whole[order]) != 0
        self.group = np.cumsum(flags) - 1
        self.least = np.minimum.reduceat(documents[owner[order]], np.flatnonzero(flags))
        flags[1:] = np.diff(shorter[order]) != 0
        edges = np.append(np.flatnonzero(flags), n)
        self.wider = edges, np.cumsum(flags) - 1

    def extend(self, low: np.ndarray, high: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the interval of ``word`` followed by the pattern so far."""
        at = self.counts[word]
        return at + self.bits.rank(word, low), at + self.bits.rank(word, high)

    def matches(self) -> list[np.ndarray]:
        """For each piece and each of its windows, the smallest document that holds the window."""
        out = [np.zeros(max(0, s - self.window + 1), np.int64) for s in self.sizes]
        flat = np.concatenate([[0], np.cumsum([len(o) for o in out])])
        found = np.zeros(int(flat[-1]), np.int64)
        low, high = np.zeros(len(out), np.int64), np.full(len(out), len(self.text), np.int64)
        edges, group = self.wider
        by = np.argsort(-self.sizes, kind="stable")
        sizes, start, base = self.sizes[by], self.start[by], flat[:-1][by]
        for step in range(int(sizes[0]) if len(sizes) else 0):
            active = int(np.searchsorted(-sizes, -step, "left"))  # pieces longer than this step
            low[:active], high[:active] = self.extend(
                low[:active], high[:active], self.text[start[:active] + sizes[:active] - 1 - step]
            )
            if step >= self.window - 1:
                found[base[:active] + sizes[:active] - 1 - step] = self.least[self.group[low[:active]]]
                place = group[low[:active]]
                low[:active], high[:active] = edges[place], edges[place + 1]
        return [found[flat[k] : flat[k + 1]] for k in range(len(out))]


def _shard(window: int, rows: pd.DataFrame) -> pd.DataFrame:
    """``runs`` of windows with one smallest document, for the pieces that some document with a larger id holds."""
    pieces = [np.frombuffer(w, np.uint64) for w in rows["words"]]
    found = FMIndex(pieces, rows["least"].to_numpy(np.int64), window).matches()
    out = []
    for spot, piece, most, least in zip(rows["spot"], rows["piece"], rows["most"], found, strict=True):
        if least.min() < most:
            first = np.flatnonzero(np.append(True, np.diff(least) != 0))
            size = np.diff(np.append(first, len(least)))
            out.append((spot, piece, [{"o": int(o), "n": int(n), "m": int(m)} for o, n, m in zip(first, size, least[first])]))
    return pd.DataFrame(out, columns=["spot", "piece", "runs"])


def _cut_out(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, digests, texts = [], [], [], []
        for text, spans in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            words = (text.as_py() or "").encode().split()  # bytes split at the same six blanks
            gone = np.zeros(len(words) + 1, np.int64)
            for span in spans or ():
                gone[span["s"]] += 1
                gone[span["s"] + span["n"] + window - 1] -= 1
            keep = np.cumsum(gone)[:-1] == 0
            left = b" ".join(words if not spans else [w for w, k in zip(words, keep, strict=True) if k])
            n_words.append(len(words))
            n_removed.append(len(words) - int(keep.sum()))
            digests.append(hashlib.sha256(left).hexdigest())
            texts.append(left)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            + [pa.array(texts, pa.binary()).cast(pa.string())] * (batch.num_columns > 3),
            ["id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * (batch.num_columns > 3),
        )


_OUT_WITH_TEXT = "id {}, n_words long, n_removed long, kept_sha256 string, kept_text string"


def removable_spans(docs: DataFrame, window: int) -> DataFrame:
    """``id, key, spans`` for the documents (``id, text, key``) that lose words; a span is ``n`` windows from word ``s``.

    Rows that repeat id and text are one document here, whatever their number.
    """
    if not docs.groupBy("id", "key").count().filter("count > 1").isEmpty():
        docs = docs.dropDuplicates(["id", "key"])
    segments = kept(in_batches(docs).filter("id IS NOT NULL").select("id", "text", "key").mapInArrow(partial(_segments, window), _SEGMENTS), "segments")
    shared = segments.groupBy("dealt").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("dealt")
    live = kept(segments.join(shared, "dealt"), "live")
    one_each = (
        live.groupBy("dealt", "print").agg(F.min(F.struct("id", "key", "start", "words")).alias("h"), F.max("id").alias("most"))
    )
    wide = one_each.groupBy("dealt").count().select("dealt", (F.col("count") > WIDE_KEY).alias("wide"))
    held = (
        one_each.join(wide, "dealt")
        .select(
            F.col("h.id").alias("id"), F.col("h.key").alias("key"),
            F.struct(F.col("h.start").alias("start"), F.col("h.words").alias("words"), "dealt", "print", F.col("h.id").alias("least"), "most", "wide").alias("s"),
        )
        .groupBy("id", "key").agg(F.collect_list("s").alias("segments"))
    )
    pieces = kept(
        docs.join(held, ["id", "key"]).select("text", "segments").mapInArrow(partial(_pieces, window), _PIECES), "pieces"
    )
    # only the windows of wide keys can come more than once
    whole = pieces.filter("spot = dealt AND piece = print").select("spot", "piece", "least", "most", "words")
    single = pieces.filter("NOT (spot = dealt AND piece = print)").groupBy("spot", "piece").agg(
        F.min("least").alias("least"), F.max("most").alias("most"), F.min("words").alias("words")
    )
    total = pieces.agg(F.sum(F.length("words") / 8)).first()[0] or 0
    shards = max(8, int(total) // SHARD_WORDS + 1)
    found = kept(
        whole.union(single).groupBy(F.pmod(F.xxhash64("spot"), F.lit(shards))).applyInPandas(
            partial(_shard, window), "spot long, piece long, runs array<struct<o:int,n:int,m:long>>"
        ),
        "found",
    )
    repeated = pieces.select("dealt", "print", "at", "spot", "piece").distinct().join(found, ["spot", "piece"]).select("dealt", "print", "at", "runs")
    own = F.filter("runs", lambda r: r["m"] < F.col("id"))
    moved = F.transform(own, lambda r: F.struct((F.col("start") + F.col("at") + r["o"]).alias("s"), r["n"].alias("n")))
    return (
        live.join(repeated, ["dealt", "print"])
        .select("id", "key", moved.alias("spans"))
        .filter(F.size("spans") > 0)
        .groupBy("id", "key")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def substring_dedup(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", window: int = 50, with_text: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked, ``kept_text``."""
    if not 2 * KEY_WORDS <= window <= 64:
        raise ValueError("a window has 16 to 64 words")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    spans = kept(removable_spans(docs, window), "spans")
    work = docs.join(spans, ["id", "key"], "left").select("id", "text", "spans", *([F.lit(True).alias("t")] if with_text else []))
    out = _OUT_WITH_TEXT.format("long")
    return in_batches(work).mapInArrow(partial(_cut_out, window), out if with_text else out.rpartition(",")[0]).withColumnRenamed("id", id_col)
