from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import phrases as ph

SCHEMA = "doc_id long, text string, lang string, phrase string, key long, n int, rank int, f long"


def _table(spark, rows):
    return spark.createDataFrame([(k, t, g, "x", 1, 2, 3, 4) for k, (t, g) in enumerate(rows)], SCHEMA)


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _counts(rows, longest=5):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return f, n


def _brute(rows, least, top, covered=100, longest=5):
    f, n = _counts(rows, longest)
    found = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    out = []
    per_lang = defaultdict(list)
    for (lang, p), a in found.items():
        if any(
            g == lang and len(q) > len(p) and covered * a <= 100 * b and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (g, q), b in found.items()
        ):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        per_lang[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    for lang, own in per_lang.items():
        for rank, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def _texts(n, seed, langs=("en", "de", None)):
    draw = random.Random(seed)
    vocabulary = ["a", "B", "c", "d", "é", "ff", "İ", "g\x0bh", "naïve", "x-y"]
    rows = []
    for _ in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(30))]
        if draw.random() < 0.5:
            words[3:3] = ["The", "quick", "brown", "fox", "runs"][: draw.randrange(2, 6)]
        rows.append(("".join(w + draw.choice([" ", "  ", "\t", " ", ", ", ".", "\n", "\r\n", "; "]) for w in words), draw.choice(langs)))
    return rows


AWKWARD = [(None, "en"), ("", None), (" \t\n.,;", "en"), ("word " * 30_000, "en"), ("no end " + "x" * 50_000, "de"), ("\x00 \U0001f600", "und")]


@pytest.mark.parametrize("shard_bytes, most_local", [(1 << 20, 4), (900, 4), (900, 1), (3000, 50)])
def test_equals_brute_force(spark, shard_bytes, most_local):
    rows = _texts(300, 1) + AWKWARD
    df = ph.collocations(_table(spark, rows).repartition(3), min_count=12, top=25, shard_bytes=shard_bytes, most_local=most_local)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, df.collect())) == _brute(rows, 12, 25)


def test_few_bits_and_partial_cover_change_nothing(spark):
    rows = _texts(200, 2, ("en",))
    df = ph.collocations(_table(spark, rows), min_count=10, top=500, covered=80, table_bits=8)  # nearly every mark is a chance one
    assert sorted(map(tuple, df.collect())) == _brute(rows, 10, 500, covered=80)


def test_counts_of_all_lengths_are_exact(spark):
    rows = _texts(150, 3)
    got = {(r.lang, r.phrase): r.f for r in ph.phrase_counts(_table(spark, rows).repartition(4), min_count=8, shard_bytes=500).collect()}
    f, n = _counts(rows)
    want = {(g, " ".join(p)): a for (g, p), a in f.items() if a >= 8} | {(g, None): a for g, a in n.items()}
    assert got == want


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_shorter_phrases_only(spark, longest):
    rows = _texts(80, 4)
    assert sorted(map(tuple, ph.collocations(_table(spark, rows), min_count=6, longest=longest).collect())) == _brute(rows, 6, 2000, longest=longest)


def test_products_beyond_64_bits_are_exact(spark):
    # 1000 * a * n and l * r pass 64 bits when counts do not
    a, n, left, right = 3_000_000_019, 90_000_000_000_007, 5_000_000_003, 7_000_000_001
    whole = "cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(18,0)))"
    got = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").selectExpr(f"{whole} AS s").first()
    assert got.s == 1000 * a * n // (left * right)


def test_frequent_phrases_of_a_shard_equal_brute_force():
    rows = _texts(120, 6)
    batch = pa.record_batch([pa.array([g or "und" for _, g in rows]), pa.array([t for t, _ in rows])], ["lang", "text"])
    (shard,) = ph.shards([batch], 1 << 20, True)
    f, _ = _counts(rows)
    want = {(g, " ".join(p)): a for (g, p), a in f.items() if a >= 5}
    names = list(shard.names)
    got = {
        (names[shard.lang[i]], shard.phrase(i, n)): int(c)
        for n, at, _, count in ph.frequent(shard, 5, (1, 2, 3, 4, 5), None)
        for i, c in zip(at.tolist(), count, strict=True)
    }
    assert got == want


def test_shards_are_bounded_and_whole():
    texts = ["ab " * k for k in range(1, 60)]
    batch = pa.record_batch([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])
    found = list(ph.shards([batch], 600, False))
    assert sum(s.size for s in found) == sum(map(len, texts)) and max(s.size for s in found) <= 700
    assert sum(len(s.words) for s in found) == sum(range(1, 60))
    assert all(s.follows.sum() == len(s.words) - len(np.flatnonzero(~s.follows)) for s in found)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("a b", "en")]])
def test_nothing_frequent_gives_no_rows(spark, rows):
    assert ph.collocations(_table(spark, rows)).collect() == []
