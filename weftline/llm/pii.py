"""Personal data: four exact base patterns, and spans added by a character BiLSTM with CRF transitions.

Base spans are the leftmost non-overlapping matches of each kind that pass the
kind's test; failing ones are dropped, nothing is tried again.

The tagger reads characters in windows of ``WINDOW`` with half overlap: a
forward and a backward LSTM over character classes, a linear layer, and a
linear-chain CRF, all in numpy. It is trained on windows with labelled spans:
base spans of a bounded hash sample of the texts, and the same windows with a
span rewritten into a form that no base pattern takes (a phone number without
``+``, an address with ``[at]``, a card number with dots). Each window is decoded
by Viterbi; every character takes the tag of the window in which it is nearest
the middle, and spans are read from that one sequence over the whole text, so
they may be longer than a window. A span that touches a base span, or that could
not be of its kind at all, is left out. Every kind has a digit, an at sign or a
rewritten one (``[at]``, `` at ``, ``(at)``, in any case); windows in which none
of these stands are not scored, nor those farther than two from a rewritten one.

Null text: an empty one, without spans. Long texts are read whole. Repeated
rows: one result each. Without any training span only base spans are found.
Empty table: no rows. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

#: The base patterns. A start inside a run of digits can't match if the run's start does not.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: What may stand for an at sign.
AT = re.compile(r"[\[(\x20]at(?=[\])\x20])", re.ASCII | re.IGNORECASE)

WINDOW, STEP, HIDDEN = 64, 32, 16

#: Bounds of the training sample: texts asked, windows from one text, windows in all; and the passes over them.
SAMPLE_TEXTS, WINDOWS_OF_TEXT, SAMPLE_WINDOWS, EPOCHS, BATCH, RATE = 6_000, 6, 5_000, 10, 64, 0.01

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
Span = tuple[int, int, int]  # place of the kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    behind, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            behind = found.end()
        at = text.find("@", max(behind, at + 1))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The base spans by kind, then start."""
    found = [(0, s, e) for s, e in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return found


# Characters -------------------------------------------------------------------

PAD, ALIEN, ALIEN_LETTER = 0, 1, 2
_CLASS = np.zeros(128, np.int64)
_CLASS[:] = np.arange(128) + 3
_CLASS[48:58] = 48 + 3  # one class for digits
CLASSES = 131
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _classes(codes: np.ndarray) -> np.ndarray:
    out = np.where(codes >= 0xC0, ALIEN_LETTER, ALIEN)
    plain = codes < 128
    out[plain] = _CLASS[codes[plain]]
    return out


def tags_of(spans: list[Span], start: int, size: int) -> np.ndarray:
    """Tags of a window; a span that began before it goes on inside."""
    out = np.zeros(size, np.int64)
    for kind, s, e in spans:
        a, b = max(s, start) - start, min(e, start + size) - start
        if a < b:
            out[a:b] = 2 + 2 * kind
            if s >= start:
                out[a] = 1 + 2 * kind
    return out


# The tagger ---------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Tagger:
    """A bidirectional LSTM over character classes with CRF transitions."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 3, dtype=np.float32):
        draw = np.random.default_rng(seed)
        self.hidden = hidden
        self.p: dict[str, np.ndarray] = {}
        for side in "fb":
            self.p[f"in_{side}"] = draw.normal(0, 0.3, (CLASSES, 4 * hidden))
            self.p[f"rec_{side}"] = draw.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            self.p[f"in_{side}"][:, hidden : 2 * hidden] += 1.0  # remember at first
        self.p["out"] = draw.normal(0, 0.3, (2 * hidden, TAGS))
        self.p["bias"] = np.zeros(TAGS)
        self.p["move"] = np.zeros((TAGS, TAGS))
        self.p = {k: v.astype(dtype) for k, v in self.p.items()}
        self.banned = np.zeros((TAGS, TAGS), dtype)
        for b in range(2, TAGS, 2):  # inside only follows begin or inside of its kind
            for a in range(TAGS):
                if a not in (b - 1, b):
                    self.banned[a, b] = -1e4

    def _lstm(self, side: str, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States for each place of ``x`` (rows by places); the backward side runs from the end."""
        into, rec, H = self.p[f"in_{side}"], self.p[f"rec_{side}"], self.hidden
        rows, size = x.shape
        h = np.zeros((rows, H), into.dtype)
        c = np.zeros_like(h)
        states, tape = np.empty((size, rows, H), into.dtype), []
        for t in range(size) if side == "f" else range(size - 1, -1, -1):
            z = into[x[:, t]] + h @ rec
            gates = _sigmoid(z[:, : 3 * H])
            i, f, o = gates[:, :H], gates[:, H : 2 * H], gates[:, 2 * H :]
            g = np.tanh(z[:, 3 * H :])
            before, last = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[t] = h
            if keep:
                tape.append((t, i, f, o, g, before, tc, last))
        return states, tape

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Tag scores, places by rows by tags."""
        both = np.concatenate([self._lstm("f", x, False)[0], self._lstm("b", x, False)[0]], 2)
        return both @ self.p["out"] + self.p["bias"]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tag sequence of every row."""
        scores, move = self.emissions(x), self.p["move"] + self.banned
        size, rows, _ = scores.shape
        best, back = scores[0], np.empty((size, rows, TAGS), np.int8)
        for t in range(1, size):
            paths = best[:, :, None] + move
            back[t] = paths.argmax(1)
            best = np.take_along_axis(paths, back[t][:, None].astype(np.int64), 1)[:, 0] + scores[t]
        out = np.empty((rows, size), np.int64)
        out[:, -1] = best.argmax(1)
        for t in range(size - 1, 0, -1):
            out[:, t - 1] = back[t][np.arange(rows), out[:, t]]
        return out

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tag sequences and its gradients."""
        H, (rows, size) = self.hidden, x.shape
        (hf, tape_f), (hb, tape_b) = self._lstm("f", x, True), self._lstm("b", x, True)
        both = np.concatenate([hf, hb], 2)
        scores = both @ self.p["out"] + self.p["bias"]
        move = self.p["move"] + self.banned

        def logsum(v: np.ndarray, axis: int) -> np.ndarray:
            top = v.max(axis, keepdims=True)
            return (np.log(np.exp(v - top).sum(axis, keepdims=True)) + top).squeeze(axis)

        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, size):
            ahead[t] = logsum(ahead[t - 1][:, :, None] + move, 1) + scores[t]
        for t in range(size - 2, -1, -1):
            behind[t] = logsum(move + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        total = logsum(ahead[-1], 1)
        at = np.arange(rows)
        gold = sum(scores[t][at, y[:, t]] for t in range(size)) + sum(move[y[:, t - 1], y[:, t]] for t in range(1, size))
        d_scores = np.exp(ahead + behind - total[None, :, None])
        d_move = np.zeros_like(move)
        for t in range(1, size):
            pair = ahead[t - 1][:, :, None] + move + (scores[t] + behind[t])[:, None, :] - total[:, None, None]
            d_move += np.exp(pair).sum(0)
            np.subtract.at(d_move, (y[:, t - 1], y[:, t]), 1)
        for t in range(size):
            d_scores[t][at, y[:, t]] -= 1
        d_scores /= rows
        grads = {"move": d_move / rows, "out": np.einsum("trh,trk->hk", both, d_scores), "bias": d_scores.sum((0, 1))}
        d_both = d_scores @ self.p["out"].T
        for side, tape, d_h in (("f", tape_f, d_both[:, :, :H]), ("b", tape_b, d_both[:, :, H:])):
            rec = self.p[f"rec_{side}"]
            d_in, d_rec = np.zeros_like(self.p[f"in_{side}"]), np.zeros_like(rec)
            next_h, next_c = np.zeros((rows, H), rec.dtype), np.zeros((rows, H), rec.dtype)
            for t, i, f, o, g, before, tc, last in reversed(tape):
                dh = d_h[t] + next_h
                dc = next_c + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
                np.add.at(d_in, x[:, t], dz)
                d_rec += last.T @ dz
                next_h, next_c = dz @ rec.T, dc * f
            grads[f"in_{side}"], grads[f"rec_{side}"] = d_in, d_rec
        return float((total - gold).mean()), grads


def train(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Tagger | None:
    """Adam over shuffled batches; nothing to learn without a span."""
    if not len(x) or not y.any():
        return None
    tagger, draw = Tagger(), np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    square = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    step, steps = 0, epochs * -(-len(x) // BATCH)
    for _ in range(epochs):
        order = draw.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            _, grads = tagger.loss(x[rows], y[rows])
            step += 1
            rate = RATE * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                g = np.clip(g, -5, 5)
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                tagger.p[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return tagger


# Decoding whole texts -------------------------------------------------------------


def _windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the windows that may hold a part of a span, and their character classes."""
    codes = _codes(text)
    spots = np.flatnonzero(((codes >= 48) & (codes <= 57)) | (codes == 64)) // STEP
    near = np.array([m.start() for m in AT.finditer(text)], np.int64) // STEP
    numbers = np.unique(np.concatenate([spots, spots - 1, *(near + k for k in (-2, -1, 0, 1))]))
    numbers = numbers[(numbers >= 0) & (numbers * STEP < len(codes))]
    if not len(numbers):
        return np.zeros(0, np.int64), np.zeros((0, WINDOW), np.int64)
    padded = np.full((int(numbers[-1]) * STEP + WINDOW), PAD)
    known = _classes(codes[: len(padded)])
    padded[: len(known)] = known
    return numbers, padded[numbers[:, None] * STEP + np.arange(WINDOW)]


def reconciled(numbers: np.ndarray, tags: np.ndarray) -> list[Span]:
    """One tag sequence from overlapping windows, read as spans of the whole text."""
    edge = (WINDOW - STEP) // 2
    found: list[Span] = []
    kind, start, end = -1, 0, -1
    for k, number in enumerate(numbers):
        first = edge if k and numbers[k - 1] == number - 1 else 0
        last = WINDOW - edge if k + 1 < len(numbers) and numbers[k + 1] == number + 1 else WINDOW
        row, base = tags[k], int(number) * STEP
        for t in np.flatnonzero(row[first:last]) + first:
            here, tag = base + int(t), int(row[t])
            if tag % 2 == 0 and kind == (tag - 2) // 2 and end == here:
                end = here + 1
                continue
            if kind >= 0:
                found.append((kind, start, end))
            kind, start, end = (tag - 1) // 2, here, here + 1
    return [*found, (kind, start, end)] if kind >= 0 else found


def plausible(kind: int, piece: str) -> bool:
    """What any value of the kind has."""
    n = len(_digits(piece))
    if kind == 0:
        return "@" in piece[1:] and "." in piece.partition("@")[2] or bool(re.search(r".[\[(\x20]at[\])\x20].", piece, re.ASCII | re.IGNORECASE))
    if kind == 1:
        parts = re.findall(r"[0-9]+", piece)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 13 <= n <= 19 and luhn(_digits(piece)) if kind == 2 else 8 <= n <= 15


def added_spans(texts: list[str], base: list[list[Span]], tagger: Tagger | None) -> list[list[Span]]:
    """Spans of the tagger beside the base ones, for a batch of texts."""
    out: list[list[Span]] = [[] for _ in texts]
    if tagger is None:
        return out
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
    held = 0

    def settle() -> None:
        nonlocal held
        if not waiting:
            return
        x = np.concatenate([w for _, _, w in waiting])
        tags = np.concatenate([tagger.decode(x[a : a + 1024]) for a in range(0, len(x), 1024)])
        at = 0
        for k, numbers, rows in waiting:
            text = texts[k]
            for kind, s, e in reconciled(numbers, tags[at : at + len(rows)]):
                while s < e and text[s : s + 1].isspace():
                    s += 1
                e = min(e, len(text))
                while e > s and (text[e - 1].isspace() or text[e - 1] in ".,;"):
                    e -= 1
                if s < e and not any(a < e and s < b for _, a, b in base[k]) and plausible(kind, text[s:e]):
                    out[k].append((kind, s, e))
            at += len(rows)
        waiting.clear()
        held = 0

    for k, text in enumerate(texts):
        numbers, rows = _windows(text)
        if len(numbers):
            waiting.append((k, numbers, rows))
            held += len(rows)
            if held >= 4096:
                settle()
    settle()
    return out


# Training windows -------------------------------------------------------------------


def rewritten(kind: int, value: str, turn: int) -> str:
    """The value in a form of its kind that the base patterns do not take."""
    if kind == 0:
        return value.replace("@", ("[at]", " at ", "(at)")[turn % 3], 1)
    if kind == 1:
        return value.replace(".", (" . ", "[.]")[turn % 2])
    if kind == 2:
        digits = _digits(value)
        return (".", "/")[turn % 2].join(digits[k : k + 4] for k in range(0, len(digits), 4))
    return (value.lstrip("+"), "00" + value.lstrip("+"), value.partition(" ")[2] or value.lstrip("+"))[turn % 3]


def examples(text: str) -> Iterator[tuple[str, np.ndarray]]:
    """Windows of a text with their tags: around spans, with a span rewritten, and without any."""
    spans = base_spans(text)
    for n, (kind, s, e) in enumerate(spans[:WINDOWS_OF_TEXT]):
        turn = int.from_bytes(hashlib.blake2b(text[s:e].encode("utf-8", "replace"), digest_size=4).digest(), "little")
        start = max(0, s - turn % 32)
        yield text[start : start + WINDOW], tags_of(spans, start, WINDOW)
        other = rewritten(kind, text[s:e], turn >> 5)
        near = [x for x in spans if start <= x[1] and x[2] <= s]
        yield text[start:s] + other + text[e : e + WINDOW], tags_of([*near, (kind, s, s + len(other))], start, WINDOW)
        if n == 0:
            free = max(0, start - 3 * WINDOW)
            yield text[free : free + WINDOW], tags_of(spans, free, WINDOW)
    for m in list(re.finditer("[0-9]", text))[: 2 * WINDOWS_OF_TEXT : 4]:
        start = max(0, m.start() - 20)
        yield text[start : start + WINDOW], tags_of(spans, start, WINDOW)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(x[:WINDOW], y) for t in batch.column(0).to_pylist() if t for x, y in examples(t)]
        cells = []
        for x, _ in rows:
            line = np.zeros(WINDOW, np.int64)
            codes = _classes(_codes(x))
            line[: len(codes)] = codes
            cells.append(line.astype(np.int16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.binary()), pa.array([y.astype(np.int8).tobytes() for _, y in rows], pa.binary())], ["x", "y"]
        )


def fitted(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> Tagger | None:
    """A tagger trained on windows of about ``sample_texts`` texts, chosen by a hash; the windows reach the driver."""
    n = docs.count()
    share = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample_texts / max(n, 1)))
    seen = F.regexp_like(F.col("text"), F.lit("[0-9@]"))
    windows = docs.filter(share & seen).select("text").mapInArrow(_sampled, "x binary, y binary").distinct()
    rows = windows.orderBy(F.xxhash64("x", "y"), "x", "y").limit(SAMPLE_WINDOWS).toPandas()
    x = np.stack([np.frombuffer(c, np.int16) for c in rows["x"]]).astype(np.int64) if len(rows) else np.zeros((0, WINDOW), np.int64)
    y = np.stack([np.frombuffer(c, np.int8) for c in rows["y"]]).astype(np.int64) if len(rows) else x
    return train(x, y)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _scan(tagger: Tagger | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        base = [base_spans(t) for t in texts]
        more = added_spans(texts, base, tagger)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)]
            + [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in range(4)]
            + [
                pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base], pa.string()),
                pa.array([_joined(sorted(b + m)) for b, m in zip(base, more, strict=True)], pa.string()),
            ],
            ["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        )


def personal_data(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans and all spans of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return docs.mapInArrow(
        partial(_scan, fitted(docs)),
        f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    ).withColumnRenamed("id", id_col)
