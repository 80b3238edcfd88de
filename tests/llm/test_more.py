"""Long texts, repeated rows, clashing names and brute-force checks of what SQL cannot say."""

from __future__ import annotations

import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline.llm import mixing, pii, quality_model, quality_rules, secrets
from weftline.llm.mixing import mixed_documents
from weftline.llm.ngram_join import representatives
from weftline.llm.substring_dedup import PIECES_AT_ONCE, _pieces, removable_spans, substring_dedup
from weftline.operators import shingle_join, tables

PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


def plain(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], PLAIN)


def test_covered_values_take_one_pass():
    took = []
    for n in (10_000, 40_000):
        began = time.perf_counter()
        base, every = secrets.all_spans('password="abcdefgh12" ' * n)
        took.append(time.perf_counter() - began)
        assert len(base) == len(every) == n
    assert took[1] < 8 * took[0]


def test_runs_of_base_spans():
    base = [(0, 0, 5), (3, 2, 9), (9, 1, 12), (20, 0, 25)]
    assert secrets._joint(base) == ([0, 20], [12, 25])


SECRET = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
}


def _luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(m):
    return re.sub("[^0-9]", "", m[0])


PERSONAL = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 16 <= len(_digits(m)) <= 19 and _luhn(_digits(m))),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 8 <= len(_digits(m)) <= 15),
}


def _brute(kinds, text):
    return sorted((m.start(), name, m.end()) for name, (pattern, good) in kinds.items() for m in pattern.finditer(text) if good(m))


def _strings(pieces, n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(pieces, k=draw.randrange(14))) for _ in range(n)]


def test_base_secrets_equal_the_patterns():
    pieces = ["password", "PASSWD", "api_key", "apikey", "Token", ": ", "=", "'", '"', " ", "AKIA", "ABCD1234", "EFGH5678", "0123456789abcdef", "deadbeef", "é", "ſecret", "\n", "x.y/z=", "-"]
    for text in _strings(pieces, 20_000, 1):
        got = [(s, secrets.KINDS[k], e) for s, k, e in secrets.base_spans(text)]
        assert sorted(got) == _brute(SECRET, text), text


def test_base_personal_data_equals_the_patterns():
    pieces = ["jane.doe", "@", "example", ".com", ".", "-", " ", "4111", "1111", "192", "168", "255", "256", "0", "1", "+", "+49", "(", ")", "30", "7", "é", "\n", "%", "4111111111111111"]
    for text in _strings(pieces, 20_000, 2):
        got = [(s, pii.KINDS[k], e) for k, s, e in pii.base_spans(text)]
        assert sorted(got) == _brute(PERSONAL, text), text


def test_copies_of_rows_add_no_spans(spark):
    draw = random.Random(4)
    passage = " ".join(f"w{draw.randrange(10**6)}" for _ in range(70))
    once = [(1, "a b c " + passage, "s"), (2, passage + " x y z", "s")]
    work = lambda rows: plain(spark, rows).select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("key"))
    few = {r["id"]: sorted(map(tuple, r["spans"])) for r in removable_spans(work(once), 50).collect()}
    many = {r["id"]: sorted(map(tuple, r["spans"])) for r in removable_spans(work(once * 60), 50).collect()}
    assert few == many and set(few) == {2}
    kept = substring_dedup(plain(spark, once * 60)).groupBy("doc_id", "n_removed").count().collect()
    assert sorted(map(tuple, kept)) == [(1, 0, 60), (2, 70, 60)]


CLASHING = "doc_id long, text string, source string, __words string, __key string, __id string, key long, row string, name string, taken string, copy_id int, spans string, `a.b` int"


def test_clashing_names_are_left_alone(spark):
    rows = [(k, f"some words of text {k} and more of them here", "s", "W", "K", "I", 5, "R", "N", "T", 6, "S", 7) for k in range(4)]
    df = spark.createDataFrame([*rows, *rows[:1]], CLASHING)
    for step in (representatives, lambda d: mixed_documents(d, budget=2.0)):
        out = step(df)
        assert out.columns == df.columns
        got = [tuple(r)[3:] for r in out.collect()]
        assert got and set(got) == {("W", "K", "I", 5, "R", "N", "T", 6, "S", 7)}


def test_slots_stand_in_several_partitions(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS_A_TASK", 100)
    rows = plain(spark, [(k, "w " * 50, "ab"[k % 2]) for k in range(400)])
    _, _, lots = mixing.drawn(rows, "text", "doc_id", "source", 8, 4, 7, (3, 1, 2), 1.5, 2)
    held = lots.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert lots.rdd.getNumPartitions() > 10 and len(held) > 1


def test_long_texts_are_split_once(spark):
    took = []
    for n in (20_000, 80_000):
        df = plain(spark, [(0, " ".join(f"w{k}" for k in range(n)), "a"), (1, "b c", "b")])
        began = time.perf_counter()
        text = mixed_documents(df, budget=1.0).filter("doc_id = 0").first()["text"]
        took.append(time.perf_counter() - began)
        assert len(text.split()) >= 0.5 * n
    assert took[1] < 4 * took[0] + 5


def test_words_taken_equal_a_plain_packing(spark):
    """Every document's share, from slots and blocks laid out one word at a time."""
    rows = [(k, " ".join(["w"] * (k % 23)), ["a", "b", None][k % 3]) for k in range(90)]
    df = plain(spark, rows)
    packed, goals, lots = mixing.drawn(df, "text", "doc_id", "source", 8, 4, 7, (3, 1, 2), 1.5, 2)
    owner = {}
    for r in packed.collect():
        for at in range(r["size"]):
            owner[r["src"], r["start"] + at] = r["id"]
    want = dict.fromkeys(range(90), 0)
    for s in lots.collect():
        for at in range(s["words"]):
            want[owner[s["src"], s["block"] * 8 + at]] += 1
    got = {r["doc_id"]: r["taken"] for r in mixing.mix(df, block_words=8, shards=4).collect()}
    assert got == want
    totals = {r["src"]: r["target"] for r in goals.collect()}
    assert all(abs(sum(s["words"] for s in lots.collect() if s["src"] == src) - t) <= 1 for src, t in totals.items())


def test_fit_is_bounded_on_repeated_ids(spark, monkeypatch):
    sizes = []
    fitted = quality_model.fit
    monkeypatch.setattr(quality_model, "fit", lambda x, y: (sizes.append(len(y)), fitted(x, y))[1])
    rows = [(1, f"text {k} " * (k % 40), "s") for k in range(600)] + [(2, "same words", "s")] * 600 + [(k, f"other {k}", "s") for k in range(10, 60)]
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), *((k, k % 2) for k in range(10, 60))], "doc_id long, quality int")
    assert quality_model.quality_scores(plain(spark, rows), labels, max_rows=100).count() == len(rows)
    assert sizes[0] <= 200


def test_one_tree_equals_brute_force():
    """The first cut of the first tree is the best of all cuts of all features."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, (400, len(quality_model.FEATURES))).astype(np.float32)
    y = (x[:, 3] > 4).astype(float)
    flip = rng.random(400) < 0.1
    y[flip] = 1 - y[flip]
    forest = quality_model.fit(x, y)
    p = y.mean()
    grad, hess = p - y, np.full(400, p * (1 - p))
    best = (-np.inf,)
    for f in range(x.shape[1]):
        for cut in range(8):
            low = x[:, f] <= cut
            if low.sum() < quality_model.LEAST or (~low).sum() < quality_model.LEAST:
                continue
            gain = sum(grad[s].sum() ** 2 / (hess[s].sum() + quality_model.L2) for s in (low, ~low))
            best = max(best, (gain, f, cut))
    assert forest.feature[0][0] == best[1] == 3
    assert ((x[:, 3] > forest.cut[0][0]) == (x[:, 3] > best[2])).all()


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (None, "", None), (1, "x y", "a")]])
def test_pipeline_on_awkward_tables(spark, tmp_path, rows):
    import corpus_pipeline

    plain(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0


def test_tokenizer_workers_hold_a_bounded_memory(spark):
    """Parts and pairs that a worker remembers stay beside the workers of other stages."""
    import random
    import tracemalloc

    from weftline.llm.catalog import piece_model
    from weftline.llm.pieces import PieceTable, _read

    draw = random.Random(2)
    table = PieceTable(_read(piece_model()))
    tracemalloc.start()
    for _ in range(160):
        table.encode(" ".join("".join(draw.choices("abcdefghij", k=7)) for _ in range(1000)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(table.known) <= 100_000 and len(table.fits) <= 200_000 and held < 60_000_000


def test_tokenizer_shares_words_and_their_beginnings(monkeypatch):
    """Punctuation asks for no further pairs; whatever is remembered, the ids are the library's."""
    import random

    import sentencepiece
    from weftline.llm import pieces
    from weftline.llm.catalog import piece_model

    draw = random.Random(3)
    words = ["".join(draw.choices(["er", "tion", "an", "the", "é", "ou", "Sch", "n"], k=draw.randint(1, 5))) for _ in range(400)]
    words += ["x" * 41, "the" * 30, "ab\ncd", "日本"]
    reference = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    table = pieces.PieceTable(pieces._read(piece_model()))
    table.encode(" ".join(words))
    asked = len(table.fits)
    for mark in (", ", ". ", "; ", "\n", " (", "\" ", "².", "", "  "):
        text = mark.join(words)
        assert list(memoryview(table.encode(text)).cast("I")) == reference.encode(text, add_bos=True, add_eos=True)
        if mark in (", ", ". ", "; "):
            assert len(table.fits) == asked
    for name in ("MEMORY", "PREFIXES", "PAIRS"):
        monkeypatch.setattr(pieces, name, 20)
    table = pieces.PieceTable(pieces._read(piece_model()))
    for k in range(0, 400, 10):
        text = ", ".join(words[k : k + 10] * 3)
        assert list(memoryview(table.encode(text)).cast("I")) == reference.encode(text, add_bos=True, add_eos=True)
        assert max(len(table.known), len(table.older), len(table.begun), len(table.fits)) <= 20


@pytest.mark.parametrize("broadcast", [True, False])
def test_components_of_a_small_graph_leave_few_files(spark, monkeypatch, broadcast):
    """Many shuffle partitions cost a small graph neither files nor tasks; an earlier result and repeated edges change nothing."""
    from weftline.operators.tables import components

    if not broadcast:
        monkeypatch.setattr(tables, "BROADCAST_BYTES", 0)
    edges = [(k, k + 7) for k in range(300) if k % 50 > 10] + [(3, 900), (900, 3), (900, 3), (5, 5)]
    least = {x: x for e in edges for x in e}
    while any(least[a] != least[b] for a, b in edges):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        first = components(spark.createDataFrame(edges[:150], "a long, b long"))
        found = components(spark.createDataFrame(edges, "a long, b long"), start=first)
        assert {r["node"]: r["comp"] for r in found.collect()} == least and found.count() == len(least)
        assert len(found.inputFiles()) == 1 or not broadcast
        assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_workers_get_few_bytes_at_once(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 400).alias("text")).coalesce(1)

    def largest(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    for job in (quality_rules.kept_documents, secrets.redact, substring_dedup):
        try:
            job(docs)
            found = docs.mapInArrow(largest, "bytes long").agg(F.max("bytes"), F.count(F.lit(1))).first()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        assert found[0] < 2 * tables.BATCH_BYTES and found[1] >= 8


def test_a_limit_of_the_session_stays(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, "123456")
    try:
        tables.in_batches(spark.range(1))
        assert spark.conf.get(key) == "123456"
    finally:
        spark.conf.unset(key)


def test_windows_of_wide_segments_leave_in_parts():
    words = [f"w{k}" for k in range(100_000)]
    segments = [
        {"start": k, "words": 177, "dealt": k, "print": k + 1, "least": 1, "most": 2, "wide": k % 256 == 0}
        for k in range(0, len(words) - 177, 128)
    ]
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(words)], "segments": [segments]})
    found = list(_pieces(50, iter([batch])))
    assert max(b.nbytes for b in found) < 2 * PIECES_AT_ONCE
    wide = [s for s in segments if s["wide"]]
    rows = pa.Table.from_batches(found).to_pylist()
    assert len(rows) == len(segments) - len(wide) + 128 * len(wide)
    assert {(r["dealt"], r["at"]) for r in rows} == {(s["dealt"], at) for s in segments for at in range(128 if s["wide"] else 1)}


def word_batches(n_words, n_texts, different):
    """Texts of random words in batches, as ``_described`` gets them."""
    draw = np.random.default_rng(5)
    for k in range(n_texts):
        text = " ".join(draw.integers(0, different, n_words // n_texts).astype(str).tolist())
        yield pa.RecordBatch.from_pydict({"id": pa.array([k], pa.int64()), "text": pa.array([text]), "key": pa.array([k], pa.int64())})


def peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_measures_of_a_batch_stay_small():
    texts = [t for b in word_batches(600_000, 60, 100_000) for t in b.column(1).to_pylist()]
    batch = pa.RecordBatch.from_pydict({"id": list(range(60)), "text": texts})
    assert batch.nbytes > 3 << 20
    found = []
    assert peak_mb(lambda: found.extend(quality_rules._judge(list(quality_rules.RULES), iter([batch])))) < 40
    assert sum(b.num_rows for b in found) == 60


def test_counting_shingles_takes_little_beside_them():
    batches = list(word_batches(4_000_000, 400, 100_000))

    def described():
        for _ in shingle_join._described(5, iter(batches)):
            pass

    assert peak_mb(described) < 70  # the shingles themselves are 32 MB


@pytest.mark.parametrize("at_once", [1 << 22, 1000, 7])
def test_counted_shingles(monkeypatch, at_once):
    monkeypatch.setattr(shingle_join, "_COUNTED_AT_ONCE", at_once)
    batches = list(word_batches(4000, 40, 4))
    every = Counter(int(x) for b in batches for s in shingle_join._sets(b.column(1), 5) for x in s.view(np.int64))
    got, n_chunks = Counter(), -(-sum(every.values()) // at_once)
    for b in shingle_join._described(5, iter(batches)):
        for row in b.to_pylist():
            if row["kind"] == 1:
                assert row["size"] > 1
                got[row["name"]] += row["size"]
    if n_chunks == 1:
        assert got == {k: v for k, v in every.items() if v > 1}
    assert all(every[k] - n_chunks <= got[k] <= every[k] for k in every)


def test_a_worker_holds_one_order_of_shingles():
    for seed in range(3):
        shingle_join._order(np.arange(seed, 99, dtype=np.uint64).tobytes())
    assert shingle_join._order.cache_info().currsize == 1
