from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import chunk, graph


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_tree_once_each(spark, hot_rows):
    data = [("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("x", None), ("y", "x"), ("lost", "gone")]
    data += [(f"n{i}", "b") for i in range(10)] + [("u", "v"), ("v", "u")]
    out = graph.flatten_tree(spark.createDataFrame(data, "id string, parent string"), "id", "parent", hot_rows)
    got = {r["id"]: (r["root"], r["depth"]) for r in out.collect()}
    assert out.count() == len(data)
    assert got["d"] == ("a", 3) and got["n7"] == ("a", 2) and got["y"] == ("x", 1)
    assert got["a"] == ("a", 0) and got["lost"] == ("lost", 0)
    assert got["u"] == (None, None) == got["v"]


def test_deep_chain(spark):
    data = [(i, i - 1 if i else None) for i in range(200)]
    out = graph.flatten_tree(spark.createDataFrame(data, "id int, parent int"), "id", "parent")
    assert {r["id"]: r["depth"] for r in out.collect()} == {i: i for i in range(200)}


@pytest.mark.parametrize("hot_rows", [5, 10**6])
def test_reach(spark, hot_rows):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(80)] + [(0, i) for i in range(30)] + [(1, 0)]
    want, level = {0: 0}, [0]
    while level:
        level = sorted({d for s, d in edges if s in level and d not in want})
        want.update({n: max(want.values()) + 1 for n in level})
    df = spark.createDataFrame(edges, "src int, dst int")
    start = spark.createDataFrame([(0,)], "node int")
    assert {r["node"]: r["hops"] for r in graph.reach(df, start, hot_rows=hot_rows).collect()} == want
    one = {r["node"] for r in graph.reach(df, start, max_hops=1).collect()}
    assert one == {n for n, h in want.items() if h <= 1}


@pytest.mark.parametrize("hot_rows", [5, 10**6])
def test_connected_groups(spark, hot_rows):
    edges = [(i, i + 1) for i in range(100, 130)] + [(7, 300 + i) for i in range(20)] + [(50, 51), (51, 50)]
    got = {r["node"]: r["label"] for r in graph.connected_groups(spark.createDataFrame(edges, "src int, dst int"), hot_rows).collect()}
    assert got == {**{i: 100 for i in range(100, 131)}, 7: 7, **{300 + i: 7 for i in range(20)}, 50: 50, 51: 50}


DOC = "intro line\n# One\nalpha beta\n## Two  \ngamma\fdelta on page two\n\n" + "word " * 60 + "\n" + "x" * 120 + "\n#no heading"


def test_chunks(spark):
    df = spark.createDataFrame([(1, DOC), (2, ""), (3, "no line end"), (4, None)], "id int, text string")
    out = chunk.chunk(df, "text", 50).orderBy("id", "chunk_no").collect()
    one = [r for r in out if r["id"] == 1]
    assert "".join(r["chunk_text"] for r in one) == DOC
    assert [r["chunk_no"] for r in one] == list(range(len(one)))
    assert all(len(r["chunk_text"]) <= 51 for r in one)
    assert one[0]["heading"] is None and one[0]["page_num"] == 1
    assert {r["heading"] for r in one if "alpha" in r["chunk_text"]} == {"One"}
    last = one[-1]
    assert last["heading"] == "Two" and last["page_num"] == 2
    words = [r["chunk_text"] for r in one if r["chunk_text"].startswith("word")]
    assert all(w.endswith((" ", "\n")) for w in words)
    assert [(r["id"], r["chunk_text"]) for r in out if r["id"] > 1] == [(3, "no line end")]


def test_chunks_pack_lines(spark):
    text = "".join(f"line {i:03d}\n" for i in range(40))
    df = spark.createDataFrame([(1, text)], "id int, text string")
    out = [r["chunk_text"] for r in chunk.chunk(df, "text", 30).orderBy("chunk_no").collect()]
    assert out[0] == "line 000\nline 001\nline 002\n" and "".join(out) == text


def test_rag_context(spark):
    hits = spark.createDataFrame([(1, 2, "b", "é"), (1, 1, "a", 'q"'), (2, 1, None, "z")], "qid int, rank int, title string, text string")
    out = {r["qid"]: r["prompt"] for r in chunk.rag_context(hits.withColumn("q", F.lit("why?")), ["title", "text"], "q").collect()}
    assert out[1] == 'Context:\n[{"title":"a","text":"q\\""},{"title":"b","text":"é"}]\n\nQuestion: why?'
    assert out[2] == 'Context:\n[{"text":"z"}]\n\nQuestion: why?'
