"""SentencePiece (BPE model with byte fallback) encoding by a table over prefixes, and decoding.

The merge process leaves one token sequence for every prefix of a text, so every
prefix has a single last token. The table holds that token for each place: a piece ``t`` that
ends there is the last token if the last token ``s`` of the prefix before it is
compatible with it, that is, merging the characters of ``s + t`` alone gives
``s, t`` again. Whether a pair is compatible is found once, by running the merges
of both pieces side by side, and is remembered.

Pieces of the model never go on past a word into the next run of word marks, and
if none holds letters beside other characters either, they end there too: a text
is cut at these places and the parts are encoded one by one. Characters without a
piece end a part too and become byte ids. In a long part the table is filled from
left to right, and an Aho-Corasick automaton lists the pieces that end at a place;
ids are then read off backwards. In a short one only those places are filled that
its end asks for, the longest piece first, and the ids of the part and of its
short prefixes are remembered, as texts share words and words share beginnings.

Null text: an empty one, which has the begin and end ids only. Texts of any
length are encoded whole. Repeated rows: one result each. Empty table: no rows.
Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.tables import in_batches

MARK = "▁"

#: Parts up to this many characters are short, and prefixes up to this many are remembered; speed only.
PART_CHARS, PREFIX_CHARS = 40, 8

#: Parts that a worker remembers once it met them twice, and as many again from before these; prefixes that it remembers;
#: speed only. A worker outlives its tasks and stands beside the workers of other stages, so these and the next number
#: bound what it holds all the time.
MEMORY, PREFIXES = 70_000, 40_000

#: Pairs whose compatibility a worker remembers; speed only.
PAIRS = 200_000

NEVER = float("-inf")

#: Parts of a text that has blanks for marks.
_WORDS = re.compile(" *[^ ]+| +")


class PieceTable:
    """The vocabulary of a model file with its automaton; one per worker process."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        source = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = source.get_piece_size()
        self.begin, self.end, self.unknown = source.bos_id(), source.eos_id(), source.unk_id()
        self.text: list[str] = [source.id_to_piece(k) for k in range(n)]
        self.byte_of = {k: int(self.text[k][3:5], 16) for k in range(n) if source.is_byte(k)}
        self.silent = {k for k in range(n) if source.is_control(k)}
        special = self.silent | set(self.byte_of) | {self.unknown}
        self.id_of = {self.text[k]: k for k in range(n) if k not in special and not source.is_unused(k)}
        self.score = {piece: source.get_score(k) for piece, k in self.id_of.items()}
        self.byte_id = {b: k for k, b in self.byte_of.items()}
        if len(self.byte_id) != 256 or any(MARK in p.lstrip(MARK) or (p[:2] == MARK * 2 and p.strip(MARK)) for p in self.id_of):
            raise ValueError("a model with byte fallback whose pieces hold marks only in front is needed")
        automaton = ahocorasick.Automaton()
        for piece, k in self.id_of.items():
            automaton.add_word(piece, (len(piece), k))
        automaton.make_automaton()
        self.matches = automaton.iter
        self.alone = {p.replace(MARK, " ") for p in self.id_of if len(p) == 1}
        self.blank = {p.replace(MARK, " "): k for p, k in self.id_of.items()}
        self.sizes: dict[str, list[int]] = {}  # of the pieces that end in three characters, the largest first
        for end in {p[-3:] for p in self.blank if len(p) > 2}:
            self.sizes[end] = [2, 1]
        for size in sorted({len(p) for p in self.blank if len(p) > 2}):
            for end in {p[-3:] for p in self.blank if len(p) == size}:
                self.sizes[end].insert(0, size)
        self.letters = {c for c in self.alone if c.isalpha()} if " " in self.alone else set()
        letters = re.escape("".join(self.letters) or "a")
        apart = re.compile(f" *[{letters}]+| *[^ {letters}]+| +")
        if any(len(apart.findall(p)) > 1 for p in self.blank):
            self.letters, apart = set(), _WORDS
        self.parts = apart.findall
        self.code = [struct.pack("<I", k) for k in range(n)]
        self.size = [len(p) for p in self.text]
        # what an id shows by itself; bytes above 127 show nothing without their neighbours
        self.split = {k for k, b in self.byte_of.items() if b > 127}
        self.shown = [p.replace(MARK, " ") for p in self.text]
        for k in self.silent:
            self.shown[k] = ""
        for k, b in self.byte_of.items():
            self.shown[k] = chr(b)
        self.shown[self.unknown] = " \u2047 "
        self.past: dict[int, tuple[bool, list[tuple[float, str, str]]]] = {}
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.met = bytearray(1 << 20)
        self.begun: dict[str, bytes] = {}

    def history(self, token: int) -> tuple[bool, list[tuple[float, str, str]]]:
        """The merge process on a piece's own characters: best score first, then leftmost.

        Whether it ends in the piece itself, and the score of the merge to come
        with the first and the last symbol at that time, for each state.
        """
        found = self.past.get(token)
        if found is None:
            parts, states = list(self.text[token]), []
            while True:
                scores = [self.score.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
                best = max(scores, default=NEVER)
                states.append((best, parts[0], parts[-1]))
                if best == NEVER:
                    break
                k = scores.index(best)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            found = self.past[token] = len(parts) == 1, states
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of both pieces never joins them: both processes run side by side."""
        (ends, a), (also, b) = self.history(left), self.history(right)
        if not (ends and also):
            return False
        i = j = 0
        while True:
            (next_a, _, x), (next_b, y, _) = a[i], b[j]
            across = self.score.get(x + y, NEVER)
            if across != NEVER and across > next_a and across >= next_b:
                return False
            if next_a == next_b == NEVER:
                return True
            if next_a >= next_b:
                i += 1
            else:
                j += 1

    def joins(self, left: int, token: int) -> bool:
        """Whether a token can follow the last token of the prefix before it."""
        pair = left << 32 | token
        good = self.fits.get(pair)
        if good is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            good = self.fits[pair] = self.compatible(left, token)
        return good

    def run(self, text: str) -> bytes:
        """Packed ids of a text whose characters all have a piece of their own."""
        last = [-1] * len(text)  # the unique last token of the prefix that ends at each place
        for place, (size, token) in self.matches(text.replace(" ", MARK)):
            if last[place] >= 0:
                continue
            before = place - size
            if before < 0:
                if self.history(token)[0]:
                    last[place] = token
            elif last[before] >= 0 and self.joins(last[before], token):
                last[place] = token
        ids, place = [], len(text) - 1
        while place >= 0:
            if last[place] < 0:
                raise ValueError("the pieces don't cover the text")
            ids.append(last[place])
            place -= self.size[last[place]]
        return struct.pack(f"<{len(ids)}I", *ids[::-1])

    def short(self, text: str) -> bytes:
        """As ``run``, for a short text: the ids of the prefix before its last token, and that token."""
        for size in self.sizes.get(text[-3:], (2, 1)):
            token = self.blank.get(text[-size:])
            if token is None or size > len(text):
                continue
            if size == len(text):
                if self.history(token)[0]:
                    return self.code[token]
                continue
            prefix = text[:-size]
            before = self.begun.get(prefix)
            if before is None:
                before = self.short(prefix)
                if len(prefix) <= PREFIX_CHARS:
                    if len(self.begun) >= PREFIXES:
                        self.begun.clear()
                    self.begun[prefix] = before
            left = int.from_bytes(before[-4:], "little")
            good = self.fits.get(left << 32 | token)
            if good or good is None and self.joins(left, token):
                return before + self.code[token]
        raise ValueError("the pieces don't cover the text")

    def part(self, text: str) -> bytes:
        """Packed ids of one part that isn't known."""
        packed = self.older.get(text)
        if packed is not None:
            if len(self.known) < MEMORY:
                self.known[text] = packed
            return packed
        run = self.short if len(text) <= PART_CHARS else self.run
        if text[-1] in self.letters or self.alone.issuperset(text):
            packed = run(text)
        else:
            found, at = [], 0
            for k, char in enumerate(text):
                if char not in self.alone:
                    found += [run(text[at:k])] if at < k else []
                    found += [self.code[self.byte_id[b]] for b in char.replace(" ", MARK).encode()]
                    at = k + 1
            packed = b"".join([*found, run(text[at:])] if at < len(text) else found)
        if len(text) <= PART_CHARS:
            spot = hash(text) % len(self.met)
            if self.met[spot] and len(self.known) < MEMORY:  # a full one waits for the next text
                self.known[text] = packed
            self.met[spot] = 1
        return packed

    def encode(self, text: str) -> bytes:
        """All ids of a text, begin and end included, as little-endian unsigned 32-bit numbers."""
        if len(self.known) >= MEMORY:
            self.known, self.older, self.met = {}, self.known, bytearray(len(self.met))
        known, part = self.known.get, self.part
        body = [known(p) or part(p) for p in self.parts(" " + text.replace(MARK, " "))] if text else []
        return b"".join([self.code[self.begin], *body, self.code[self.end]])

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks become blanks, the one in front goes, byte ids are joined as UTF-8."""
        if self.split.isdisjoint(ids):
            text = "".join(map(self.shown.__getitem__, ids))
            head = next((k for k in ids if k not in self.silent), None)
            return text[1:] if head is not None and self.text[head].startswith(MARK) else text
        out: list[str] = []
        pending = bytearray()
        first = True
        for k in ids:
            if k in self.byte_of:
                pending.append(self.byte_of[k])
                first = False
                continue
            if pending:
                out.append(_bytes_text(bytes(pending)))
                pending.clear()
            if k in self.silent:
                continue
            piece = " ⁇ " if k == self.unknown else self.text[k]
            if first and piece.startswith(MARK):
                piece = piece[1:]
            first = False
            out.append(piece.replace(MARK, " "))
        return "".join(out) + _bytes_text(bytes(pending))


def _bytes_text(raw: bytes) -> str:
    """Bytes as UTF-8; each byte that is part of no character becomes U+FFFD."""
    if not raw:
        return ""
    try:
        return raw.decode()
    except UnicodeDecodeError as broken:
        good = raw[: broken.start].decode()
        return good + "�" + _bytes_text(raw[broken.start + 1 :])


@cache
def _table(model: bytes) -> PieceTable:
    return PieceTable(model)


def _encoded(model: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _table(model)
    for batch in batches:
        ids = [table.encode(text.as_py() or "") for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])


def _digests(model: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _table(model)
    for batch in batches:
        sizes, hashes, decoded = [], [], []
        for text in batch.column(1):  # one at a time: a batch may be large
            packed = table.encode(text.as_py() or "")
            sizes.append(len(packed) // 4)
            hashes.append(hashlib.sha256(packed).hexdigest())
            decoded.append(hashlib.sha256(table.decode(memoryview(packed).cast("I").tolist()).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
            ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _decoded(model: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _table(model)
    for batch in batches:
        texts = [table.decode(memoryview(x).cast("I").tolist()) if x is not None else "" for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])


def _read(path: str) -> bytes:
    """The model file, half a megabyte, travels with the tasks; executors need not have it."""
    with open(path, "rb") as file:
        return file.read()


def _over(docs: DataFrame, work, model_path: str, value: str, id_col: str, out: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        in_batches(docs).select(F.col(id_col).alias("id"), F.col(value).alias("value"))
        .mapInArrow(partial(work, _read(model_path)), f"id {kind}, {out}")
        .withColumnRenamed("id", id_col)
    )


def encode(docs: DataFrame, model_path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``ids`` (little-endian unsigned 32-bit numbers) of every row."""
    return _over(docs, _encoded, model_path, text, id_col, "ids binary")


def decode(tokens: DataFrame, model_path: str, ids: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``text`` of every row of ids."""
    return _over(tokens, _decoded, model_path, ids, id_col, "text string")


def round_trip(docs: DataFrame, model_path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``n_tokens`` and digests of the ids and of the text decoded from them, for every row."""
    return _over(docs, _digests, model_path, text, id_col, "n_tokens long, ids_sha256 string, decoded_sha256 string")
