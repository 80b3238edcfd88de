"""Secrets in texts: three base patterns, and values whose cheapest guess is dear.

Base spans are the leftmost non-overlapping matches of each kind, failing ones
dropped. Beside them, a value that stands after a credential word is scored by
the cost of guessing it: a dynamic program cuts it into words, dates, repeats,
keyboard walks and brute-force characters so that the summed logarithms of the
guesses are least. A value of ``MIN_CHARS`` or more whose cost reaches
``min_cost`` is a ``guess`` span, whatever its characters, unless base spans
already cover all of it. In a value of one kind of characters (letters of one
case or digits, joined by ``-_./:``), which may be prose, the words of
``common_words.txt`` can be guessed too; no value is left unscored. Spans are in
code points, end exclusive, and cover the whole match for base kinds and the
value for ``guess``.

Null text: an empty one, without spans. Long texts and long values are read
whole; every segment but a repeat or a walk has a bounded length, and these are
found in one pass, so the work grows with the length. Repeated rows: one result
each. Empty table: no rows. Further columns are not looked at by the scan and
kept by the redaction.
"""

from __future__ import annotations

import hashlib
import math
import pkgutil
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.tables import in_batches

KINDS = ("assign", "access", "hex", "guess")

#: The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16

#: Words that announce a credential, and the value after them. A scheme may stand before the value; ``bearer`` needs no
#: separator. A value that only announces another one is none.
_ANNOUNCES = (
    r"""(?:pass(?:word|wd|phrase|code|key)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret"""
    r"""|credentials?|auth(?:orization)?|bearer|login)["']?"""
)
_SCHEME = r"""(?:(?:bearer|basic|token)[\x20\t]+)?"""
CONTEXT = re.compile(
    _ANNOUNCES + r"""(?:[\x20\t]*(?::=|=>|[:=]|\bis\b(?:[\x20\t]*(?::=|=>|[:=]))?)[\x20\t]*|(?<=\bbearer)[\x20\t]+)"""
    rf"""(?:"{_SCHEME}([^"\r\n]+)"|'{_SCHEME}([^'\r\n]+)'"""
    rf"""|{_SCHEME}(?!{_ANNOUNCES}[:=]+(?!\S))(?:"([^"\r\n]+)"|'([^'\r\n]+)'|([^\s"'`<>,;]+)))""",
    re.ASCII | re.IGNORECASE,
)

#: Cost in decimal digits from which a value counts as a secret, and its least length.
MIN_COST, MIN_CHARS = 9.0, 8

#: Characters at the end of a value in which a credential word with its separator is looked for.
_TAIL = 32

#: Common words of passwords and texts, most common first.
WORDS = (
    "password", "the", "love", "qwerty", "you", "and", "monkey", "dragon", "letmein", "admin", "welcome", "login",
    "princess", "master", "sunshine", "shadow", "football", "baseball", "iloveyou", "trustno", "superman", "hello",
    "freedom", "whatever", "secret", "token", "test", "example", "user", "name", "root", "guest", "default", "change",
    "changeme", "your", "value", "here", "none", "null", "true", "false", "string", "key", "api", "access", "public",
    "private", "server", "client", "service", "account", "database", "data", "mail", "email", "phone", "home", "work",
    "office", "summer", "winter", "spring", "autumn", "monday", "friday", "sunday", "january", "march", "april", "june",
    "july", "august", "october", "december", "blue", "green", "black", "white", "red", "orange", "purple", "silver",
    "gold", "star", "moon", "sun", "angel", "baby", "daniel", "michael", "jordan", "thomas", "robert", "anna", "maria",
    "charlie", "george", "jennifer", "ashley", "london", "berlin", "paris", "house", "horse", "battery", "staple",
    "correct", "computer", "internet", "system", "windows", "google", "apple", "banana", "cookie", "coffee", "pepper",
    "flower", "tiger", "lion", "eagle", "hunter", "killer", "ninja", "soccer", "hockey", "player", "game", "music",
    "guitar", "rock", "metal", "batman", "starwars", "pokemon", "mustang", "ferrari", "porsche", "yankees", "lakers",
    "power", "money", "happy", "lucky", "magic", "matrix", "cheese", "chocolate", "nothing",
    "something", "anything", "forever", "family", "friend", "mother", "father", "brother", "sister", "for", "with",
    "this", "that", "from", "have", "not", "are", "was", "one", "two", "new", "old", "good", "my", "is", "in", "of",
)
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")

_RANK = {w: k + 1 for k, w in reversed(list(enumerate(WORDS)))}
_LONGEST = max(map(len, WORDS))
_LEET = str.maketrans("@4301!$57", "aaeoiisst")
_NEXT = {(a, b) for row in KEY_ROWS for a, b in zip(row, row[1:])}
_NEXT |= {(b, a) for a, b in _NEXT}
_YEARS = 130


def _bruteforce(char: str) -> float:
    if char.isdigit():
        return 1.0
    return math.log10(26) if char.isalpha() and char.isascii() else math.log10(33) if char.isascii() else 2.0


@lru_cache(1)
def _prose_ranks() -> tuple[dict[str, int], int]:
    """Ranks of ``WORDS`` and, behind them, the words of ``common_words.txt``; and the longest one's length."""
    more = pkgutil.get_data(__package__, "common_words.txt").decode().split()
    ranks = {w: k + 1 for k, w in enumerate(dict.fromkeys([*WORDS, *more]))}
    return ranks, max(map(len, ranks))


def _word_cost(piece: str, ranks: dict[str, int]) -> float | None:
    low = piece.lower()
    rank, extra = ranks.get(low), 0.0
    if rank is None:
        rank = ranks.get(low.translate(_LEET))
        if rank is None:
            return None
        extra = math.log10(4)
    upper = sum(c.isupper() for c in piece)
    if upper and piece not in (piece.upper(), piece.capitalize()):
        extra += math.log10(math.comb(len(piece), upper)) + math.log10(2)
    elif upper:
        extra += math.log10(2)
    return math.log10(rank) + extra


def _date_cost(piece: str) -> float | None:
    """Days with or without separators, and single years."""
    if len(piece) == 4 and piece.isdigit():
        return math.log10(_YEARS) if 1900 <= int(piece) <= 2049 else None
    parts = re.split(r"[-/.]", piece)
    if len(parts) == 1 and len(piece) in (6, 8) and piece.isdigit():
        n = len(piece) - 4
        splits = [(piece[:n], piece[n : n + 2], piece[n + 2 :]), (piece[:2], piece[2:4], piece[4:])]
    elif len(parts) == 3 and all(p.isdigit() and len(p) in (1, 2, 4) for p in parts):
        splits = [tuple(parts)]
    else:
        return None
    for a, b, c in splits:
        for year, month, day in ((a, b, c), (c, a, b), (c, b, a)):
            if len(year) in (2, 4) and len(month) <= 2 and len(day) <= 2 and 1 <= int(month) <= 12 and 1 <= int(day) <= 31:
                if len(year) == 2 or 1900 <= int(year) <= 2049:
                    return math.log10(_YEARS * 365) + (math.log10(4) if len(parts) == 3 else 0)
    return None


def _runs(value: str, joined) -> list[int]:
    """For each place, where the longest run of joined neighbours that ends there begins."""
    begin = list(range(len(value)))
    for k in range(1, len(value)):
        if joined(value[k - 1], value[k]):
            begin[k] = begin[k - 1]
    return begin


@lru_cache(1 << 16)
def guess_cost(value: str, prose: bool = False) -> float:
    """Decimal logarithm of the guesses for the cheapest way to cut ``value`` into segments; ``prose`` adds words of texts."""
    n, low = len(value), value.lower()
    ranks, longest = _prose_ranks() if prose else (_RANK, _LONGEST)
    walks = _runs(low, lambda a, b: (a, b) in _NEXT)
    steps = {d: _runs(value, lambda a, b, d=d: ord(b) - ord(a) == d) for d in (-1, 1)}
    same = _runs(value, lambda a, b: a == b)
    blocks = range(2, min(12, n // 2) + 1)
    equal = dict.fromkeys(blocks, 0)  # how many places in a row equal the one a block earlier
    best = [0.0] * (n + 1)
    for end in range(1, n + 1):
        k = end - 1
        cost = best[k] + _bruteforce(value[k])
        for begin in range(max(0, end - max(longest, 10)), end - 1):
            piece = value[begin:end]
            for found in (_word_cost(piece, ranks), _date_cost(piece)):
                if found is not None:
                    cost = min(cost, best[begin] + found)
        if end - same[k] >= 3:  # one character, repeated
            cost = min(cost, best[same[k]] + _bruteforce(value[k]) + math.log10(end - same[k]))
        for d in (-1, 1):
            if end - steps[d][k] >= 3:
                cost = min(cost, best[steps[d][k]] + 1 + math.log10(end - steps[d][k]))
        if end - walks[k] >= 4:
            turns = 1 + sum(
                (low[i + 1] > low[i]) != (low[i] > low[i - 1]) for i in range(max(walks[k] + 1, end - 24), k)
            )
            cost = min(cost, best[walks[k]] + math.log10(47) + math.log10(end - walks[k]) + turns * 0.2)
        for size in blocks:  # a block that stands twice or more
            equal[size] = equal[size] + 1 if k >= size and value[k] == value[k - size] else 0
            times = equal[size] // size + 1
            if times > 1:
                begin = end - times * size
                cost = min(cost, best[begin] + sum(map(_bruteforce, value[begin : begin + size])) + math.log10(times))
        best[end] = cost
    return best[n]


def _mixed(value: str) -> bool:
    """Two or more kinds of characters; a capital in front and the joints of names don't count."""
    kinds = {"d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in value[1:] if c not in "-_./:"}
    return len(kinds) >= 2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the base spans."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _joint(base: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs that base spans, in order, cover without a gap."""
    starts: list[int] = []
    ends: list[int] = []
    for s, _, e in base:
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def guessed_spans(text: str, base: list[tuple[int, int, int]], min_cost: float) -> list[tuple[int, int, int]]:
    found, at, done = [], 0, 0
    starts, ends = _joint(base)
    while m := CONTEXT.search(text, at):
        start, end = m.span(m.lastindex)
        value = text[start:end].rstrip(".")
        at, end = max(start, end - _TAIL), start + len(value)  # the end of a value may announce the next one
        if end <= done or len(value) < MIN_CHARS:
            continue
        run = bisect_right(starts, start) - 1
        if run >= 0 and ends[run] >= end:  # base spans leave nothing of the value
            continue
        if guess_cost(value, not _mixed(value)) >= min_cost:
            found.append((start, 3, end))
            done = end
    return found


def all_spans(text: str, min_cost: float = MIN_COST) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    base = base_spans(text)
    return base, sorted(base + guessed_spans(text, base, min_cost))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(min_cost: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[list[int]] = [[], [], []]
        digests, spans = [], []
        for text in batch.column(1).to_pylist():
            base, every = all_spans(text or "", min_cost)
            for k in range(3):
                counts[k].append(sum(kind == k for _, kind, _ in base))
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(every))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def secret_scan(docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_cost: float = MIN_COST) -> DataFrame:
    """Counts, digest of the base spans and all spans of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        in_batches(docs).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
        .mapInArrow(
            partial(_scan, min_cost),
            f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
        )
        .withColumnRenamed("id", id_col)
    )


def redacted_text(text: str, min_cost: float = MIN_COST) -> str:
    """The text with every run of overlapping spans replaced by the first one's kind in brackets."""
    out, at = [], 0
    for start, kind, end in all_spans(text, min_cost)[1]:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def _redact(place: int, min_cost: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        clean = [None if t is None else redacted_text(t, min_cost) for t in batch.column(place).to_pylist()]
        yield batch.set_column(place, batch.schema.field(place), pa.array(clean, batch.schema.field(place).type))


def redact(docs: DataFrame, text: str = "text", min_cost: float = MIN_COST) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced; null texts stay null."""
    return in_batches(docs).mapInArrow(partial(_redact, docs.columns.index(text), min_cost), docs.schema)
