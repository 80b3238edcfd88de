from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import cells, embed, neardup, search, topics
from weftline.sources.files import random_vectors


def frame(spark, matrix, name="id", parts=3):
    data = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(data, f"{name} long, embedding array<float>").repartition(parts)


def brute(queries, corpus, k):
    """Best first, ties by id."""
    scores = np.round(queries.astype(np.float32).astype(float) @ corpus.astype(np.float32).astype(float).T, 12)
    return {q: list(np.lexsort((np.arange(len(corpus)), -s))[:k]) for q, s in enumerate(scores)}


def listed(hits):
    out = {}
    for r in hits.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append(r["id"])
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    corpus = rng.standard_normal((300, 16))
    corpus[200:260] = corpus[10]  # one vector many times: ties across partitions
    return rng.standard_normal((7, 16)), corpus


def test_knn_is_exact(spark, data):
    queries, corpus = data
    hits = search.knn(frame(spark, queries, "qid"), frame(spark, corpus), 10)
    assert listed(hits) == brute(queries, corpus, 10)
    assert [r["rank"] for r in hits.filter("qid = 0").orderBy("rank").collect()] == list(range(1, 11))


def test_knn_in_query_blocks(spark, data, monkeypatch):
    queries, corpus = data
    monkeypatch.setattr(search, "BLOCK_QUERIES", 4)
    assert listed(search.knn(frame(spark, queries, "qid"), frame(spark, corpus), 5)) == brute(queries, corpus, 5)


def test_knn_edges(spark, data):
    queries, corpus = data
    few = frame(spark, corpus[:3])
    assert listed(search.knn(frame(spark, queries, "qid"), few, 10)) == brute(queries, corpus[:3], 10)
    odd = few.unionByName(spark.createDataFrame([(98, None), (99, [1.0])], few.schema))
    assert search.knn(frame(spark, queries, "qid"), odd, 10).count() == 3 * len(queries)
    none = frame(spark, queries, "qid").limit(0)
    assert search.knn(none, few, 10).count() == 0
    named = search.knn(frame(spark, queries, "qid"), few.withColumn("t", F.lit("x")), 1, fields=["t"])
    assert {r["t"] for r in named.collect()} == {"x"}


def test_knn_text_ids(spark, data):
    queries, corpus = data
    named = frame(spark, corpus).select(F.format_string("v%03d", "id").alias("id"), "embedding")
    hits = search.knn(frame(spark, queries, "qid"), named, 4)
    want = {q: [f"v{i:03d}" for i in ids] for q, ids in brute(queries, corpus, 4).items()}
    assert listed(hits) == want


def test_euclidean(spark, data):
    queries, corpus = data
    hits = search.knn(frame(spark, queries, "qid"), frame(spark, corpus), 3, metric="euclidean")
    far = np.sqrt(((queries.astype(np.float32)[:, None].astype(float) - corpus.astype(np.float32)[None]) ** 2).sum(-1))
    first = {r["qid"]: r["score"] for r in hits.filter("rank = 1").collect()}
    assert all(first[q] == pytest.approx(far[q].min()) for q in range(len(queries)))
    assert hits.groupBy("qid").agg(F.max("score") >= F.min("score")).count() == len(queries)


def test_rerank_with_all_candidates_is_exact(spark, data):
    queries, corpus = data
    q, c = frame(spark, queries, "qid"), frame(spark, corpus)
    wide = search.knn_rerank(q, c, 4, k=10, expand=30)
    assert listed(wide) == brute(queries, corpus, 10)
    narrow = search.recall(search.knn_rerank(q, c, 8, k=10, expand=2), search.knn(q, c, 10)).collect()
    assert len(narrow) == len(queries) and all(0 <= r["recall"] <= 1 for r in narrow)


def test_truncate_is_pure_and_drops_zero(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0, 1.0]), (2, [0.0, 0.0, 1.0]), (3, None)], "id long, embedding array<float>")
    short = search.truncate(df, 2).collect()
    assert [(r["id"], r["embedding"]) for r in short] == [(1, pytest.approx([0.6, 0.8]))]
    assert df.filter("id = 1").first()["embedding"] == [3.0, 4.0, 1.0]


def test_search_on_the_first_numbers(spark, data):
    queries, corpus = data
    corpus = corpus.copy()
    corpus[5, :4] = 0
    q, c = frame(spark, queries, "qid"), frame(spark, corpus)
    stored = listed(search.knn(search.truncate(q, 4), search.truncate(c, 4), 290))
    assert listed(search.knn(q, c, 290, dims=4)) == stored and all(5 not in ids for ids in stored.values())
    whole = search.knn_rerank(q, c, 4, k=10, expand=3, short=search.truncate(c, 4))
    assert listed(whole) == listed(search.knn_rerank(q, c, 4, k=10, expand=3))


def test_random_vectors_repeat(spark):
    one = random_vectors(spark, 20, 8, seed=1)
    assert one.collect() == random_vectors(spark, 20, 8, seed=1).repartition(3).orderBy(F.col("id").cast("int")).collect()
    assert all(0 <= x < 1 for r in one.collect() for x in r["values"])


def test_model_slot(spark):
    def load():
        return lambda texts, task: np.array([[len(t), float(task == "search_query")] for t in texts])

    df = spark.createDataFrame([(1, "abc"), (2, None)], "id int, t string")
    out = embed.embed(df, "t", embed.model_embedder(load, "search_query"), max_chars=2)
    assert {r["id"]: r["embedding"] for r in out.collect()} == {1: [2.0, 1.0], 2: [0.0, 1.0]}
    assert out.columns == ["id", "t", "embedding"]


def test_tfidf_finds_shared_words(spark):
    docs = spark.createDataFrame([(1, "red apple pie"), (2, "green tree leaf"), (3, "blue sea")], "id long, t string")
    fn = embed.hashed_tfidf(docs, "t", 128)
    asked = spark.createDataFrame([(0, "apple pie")], "qid long, t string")
    assert search.knn(fn(asked, "t"), fn(docs, "t"), 1).first()["id"] == 1


def _groups(rows, percent=80):
    """Each id with the smallest id of its group, from all pairs."""
    sets = {}
    for i, text in rows:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    moved = True
    while moved:
        moved = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]) and label[b] < label[a]:
                    label[a], moved = label[b], True
    return label


def _texts():
    rng = np.random.default_rng(3)
    prose = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 60)) for _ in range(25)]
    passage = " ".join(f"p{x}" for x in range(70))
    rows = list(enumerate(prose))
    rows += [(100 + k, passage + f" tail{k % 7} end{k}") for k in range(60)]  # one family around one passage
    rows += [(200 + k, " ".join([*passage.split()[k:], *[f"n{j}" for j in range(k)]])) for k in range(0, 20, 2)]  # a chain
    rows += [(300 + k, prose[k].upper() if k % 2 else prose[k] + " more") for k in range(10)]
    return rows + [(400, None), (401, ""), (402, " \n"), (403, "two words"), (404, "Two  words"), (405, "two"), (400 + 6, prose[0])]


@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_near_dups_match_brute_force(spark, hot_rows):
    rows = _texts()
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    found = {r["id"]: r["keep_id"] for r in neardup.near_dups(df, hot_rows=hot_rows).collect()}
    assert found == _groups(rows)


def test_near_dups_do_not_depend_on_other_rows(spark):
    base = " ".join(f"w{k}" for k in range(80))
    near = [(k, f"{base} x{k}") for k in range(200)]
    other = [(1000 + k, " ".join(f"u{k}_{j}" for j in range(30))) for k in range(1000)]
    rows = spark.createDataFrame(near + other, "id long, text string")
    found = {r["id"]: r["keep_id"] for r in neardup.near_dups(rows).collect()}
    assert all(found[k] == 0 for k in range(200)) and all(found[i] == i for i, _ in other)


def test_near_dups_edges(spark):
    none = spark.createDataFrame([], "id long, text string, size int")
    assert neardup.near_dups(none).collect() == []
    rows = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (None, "x")], none.schema[:2])
    found = sorted((r["id"] or 0, r["keep_id"] or 0) for r in neardup.near_dups(rows).collect())
    assert found == [(0, 0), (0, 7), (7, 7), (7, 7)]


def test_topics_and_map(spark):
    docs = spark.createDataFrame(
        [(i, "cat purr milk" if i % 2 else "rocket moon orbit") for i in range(20)], "id long, text string"
    )
    mapped = topics.build_index(docs, "id", "text", n_topics=2)
    got = mapped.collect()
    assert len({r["topic"] for r in got if r["id"] % 2}) == 1 and len({r["topic"] for r in got}) == 2
    assert {r["label"] for r in got} == {"cat, milk, purr", "moon, orbit, rocket"}
    assert all(r["x"] is not None and r["y"] is not None for r in got)


def test_vectors_that_are_not_finite_take_no_part(spark):
    bad = [(100 + k, [float("nan"), 1.0]) for k in range(4)] + [(200, [None, 1.0])]
    corpus = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(30)] + bad, "id int, embedding array<double>")
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "qid string, embedding array<double>")
    found = search.knn(queries, corpus.coalesce(1), 3).orderBy("rank").collect()
    assert [r["id"] for r in found] == [29, 28, 27]
    with pytest.raises(ValueError, match="unique"):
        search.knn(queries.union(queries), corpus, 3)


# Cells -----------------------------------------------------------------------------


@pytest.mark.parametrize("metric", ["dot", "euclidean"])
def test_cells_give_the_result_of_a_scan(spark, data, metric, monkeypatch):
    queries, corpus = data
    monkeypatch.setattr(cells, "BLOCK_ROWS", 50)
    monkeypatch.setattr(cells, "BLOCK_QUERIES", 3)
    q, c = frame(spark, queries, "qid"), frame(spark, corpus)
    layout = cells.build_layout(c, n_cells=12)
    hits, visited = cells.cell_search(q, layout, 10, metric)
    scan = search.knn(q, c, 10, metric)
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, scan.collect()))
    assert all(r["visited"] + r["skipped"] == (layout.size > 0).sum() for r in visited.collect())


def test_far_cells_are_skipped(spark, tmp_path):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((10, 8)) * 50
    corpus = np.repeat(centres, 40, axis=0) + rng.standard_normal((400, 8))
    queries = centres[:6] + 0.5
    q, c = frame(spark, queries, "qid"), frame(spark, corpus)
    cells.build_layout(c, str(tmp_path / "layout"), n_cells=10)
    layout = cells.open_layout(spark, str(tmp_path / "layout"))
    hits, visited = cells.cell_search(q, layout, 5, "euclidean")
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, search.knn(q, c, 5, "euclidean").collect()))
    assert min(r["skipped"] for r in visited.collect()) >= 5


def test_cell_bounds_hold(spark, data):
    queries, corpus = data
    layout = cells.build_layout(frame(spark, corpus), n_cells=9)
    rows = layout.rows.collect()
    for metric in ("dot", "euclidean"):
        top = cells.bounds(layout, queries, metric)
        for r in rows:
            v = np.array(r["v"])
            score = queries @ v if metric == "dot" else -np.sqrt(((queries - v) ** 2).sum(1))
            assert (score <= top[:, r["cell"]] + 1e-12).all()


def test_cells_of_few_and_odd_rows(spark):
    schema = "id long, embedding array<float>"
    odd = spark.createDataFrame([(0, [1.0, 0.0]), (1, None), (2, [1.0]), (3, [float("nan"), 1.0]), (4, [0.0, 2.0])], schema)
    layout = cells.build_layout(odd)
    asked = spark.createDataFrame([(0, [1.0, 1.0]), (1, [1.0])], "qid long, embedding array<float>")
    hits, _ = cells.cell_search(asked, layout, 5)
    assert sorted((r["qid"], r["id"], r["rank"]) for r in hits.collect()) == [(0, 0, 2), (0, 4, 1)]
    assert sorted(map(tuple, search.left_out(odd, 2).collect())) == [(1, "no vector"), (2, "another length"), (3, "a number that is not finite")]
    none = cells.build_layout(odd.limit(0))
    assert cells.cell_search(asked, none, 5)[0].collect() == []


def test_cells_write_each_vector_a_few_times(spark, monkeypatch):
    """Disk and shuffle follow the vectors, not the pairs of blocks that meet: 60 blocks of rows and 60 of queries here."""
    from pathlib import Path

    monkeypatch.setattr(cells, "BLOCK_ROWS", 50)
    monkeypatch.setattr(cells, "BLOCK_QUERIES", 50)
    corpus = np.random.default_rng(6).standard_normal((3000, 32))
    c = frame(spark, corpus).localCheckpoint()
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def size():
        shuffled = blocks.getAllFiles()
        return sum(shuffled.apply(k).length() for k in range(shuffled.size())) + sum(p.stat().st_size for p in shared.rglob("*.parquet"))

    before = size()
    hits, _ = cells.cell_search(c.withColumnRenamed("id", "qid"), cells.build_layout(c, n_cells=2), 5)
    assert listed(hits) == brute(corpus, corpus, 5)
    assert size() - before < 16 * corpus.size * 4


def test_cells_keep_types_and_ties(spark, monkeypatch):
    """Doubles stay doubles, ids of any type, queries of another type; equal vectors of several blocks rank by id."""
    monkeypatch.setattr(cells, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(8)
    corpus = np.concatenate([rng.standard_normal((40, 3)) * (1 + 1e-9), np.tile([1 / 3, 2.0, 0.1], (30, 1))])
    c = spark.createDataFrame([(f"r{k:02}", v.tolist()) for k, v in enumerate(corpus)], "id string, embedding array<double>").repartition(4)
    asked = [(("a", 1), [1.0, 2.0, 0.5]), (("b", None), [0.1, 0.2, -3.0]), (None, [1.0, 1.0, 1.0])]
    q = spark.createDataFrame(asked, "qid struct<x: string, y: int>, embedding array<float>")
    layout = cells.build_layout(c, n_cells=5)
    for metric in ("dot", "euclidean"):
        hits, visited = cells.cell_search(q, layout, 12, metric)
        scan = search.knn(q, c, 12, metric)
        key = lambda r: (repr(r["qid"]), r["rank"])
        assert sorted(hits.collect(), key=key) == sorted(scan.select(hits.columns).collect(), key=key)
        assert hits.schema == scan.schema and visited.count() == 3
    with pytest.raises(ValueError, match="unique"):
        cells.cell_search(q.union(q), layout, 3)


def test_many_queries_stay_distributed(spark, data, monkeypatch):
    queries, corpus = data
    monkeypatch.setattr(search, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(search, "BLOCK_ROWS", 40)
    q, c = frame(spark, queries, "qid"), frame(spark, corpus)
    for metric in ("dot", "euclidean"):
        got = search.knn(q, c, 8, metric)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan
        with monkeypatch.context() as patch:
            patch.setattr(search, "BLOCK_QUERIES", 2048)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, search.knn(q, c, 8, metric).collect()))
    assert listed(search.knn(q, c, 290, dims=4)) == listed(search.knn(search.truncate(q, 4), search.truncate(c, 4), 290))
    assert listed(search.knn_rerank(q, c, 4, k=10, expand=30)) == brute(queries, corpus, 10)


def test_near_dups_write_less_than_their_sets(spark, tmp_path):
    """No list of a text's shingles is written: eight bytes for each word would be more than the texts."""
    import random
    from pathlib import Path

    draw = random.Random(5)
    texts = [" ".join(f"{draw.randrange(10**4)}" for _ in range(2000)) for _ in range(100)]
    spark.createDataFrame(list(enumerate(texts)), "id long, text string").write.parquet(str(tmp_path / "in"))
    shared = spark.sparkContext.getCheckpointDir() or ""
    folder = spark.conf.get("spark.checkpoint.dir", None) or shared
    size = lambda: sum(p.stat().st_size for p in Path(folder.removeprefix("file:")).rglob("*") if p.is_file())
    before = size()
    found = neardup.near_dups(spark.read.parquet(str(tmp_path / "in"))).collect()
    assert all(r["id"] == r["keep_id"] for r in found) and len(found) == 100
    assert size() - before < 100 * 2000 * 8


def test_pairs_of_blocks_hold_few_scores(spark):
    """A full block of the corpus and a full block of queries meet without a score for every pair at once, ties or not."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    for equal in (False, True):
        rows, queries = (np.ones((n, 8)) if equal else rng.normal(size=(n, 8)) for n in (8192, 2048))
        left = pa.table({"id": pa.array(range(8192), pa.int64()), "v": pa.array(list(rows), pa.list_(pa.float64()))})
        right = pa.table({"qid": pa.array(range(2048), pa.int64()), "v": pa.array(list(queries), pa.list_(pa.float64()))})
        tracemalloc.start()
        found = search._pair_of_blocks(3, "dot", None, 8, [pa.int64(), pa.int64()], left, right).to_pandas()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        best = np.argsort(-np.round(rows @ queries[:50].T, 12), axis=0, kind="stable")[:3].T
        assert found.groupby("qid")["id"].apply(list).tolist()[:50] == best.tolist()
        assert len(found) == 3 * 2048 and peak < 8192 * 2048 * 8


def test_layout_is_searched_in_small_runs(spark):
    """Rows and queries are measured against the cells a few at a time, with the results of one run."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    vectors, centres = rng.normal(size=(10_000, 4)), rng.normal(size=(1024, 4))
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array(list(vectors), pa.list_(pa.float64()))], ["id", "v"])
    tracemalloc.start()
    cell = [c for b in cells._nearest_cell(centres, iter([batch])) for c in b.column(2).to_pylist()]
    n = sum(b.num_rows for b in cells._visits((centres, np.full(1024, 0.1), np.full(1024, 5)), "dot", 5, False, iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 10_000 and peak < 10_000 * 1024 * 8
    for k in (0, 511, 9_999):
        assert cell[k] == ((centres - vectors[k]) ** 2).sum(axis=1).argmin()
