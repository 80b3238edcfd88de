from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from weftline.sources import files, lines


@pytest.fixture
def small_blocks(spark):
    """Files are split every few hundred bytes."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _cells(n, seed):
    draw = random.Random(seed)
    parts = ["a", ", ", '"', "\n", "\r\n", "\n\n", "é", '5" pipe', ",", " x ", '""', "\\"]
    return [[str(k), "".join(draw.choices(parts, k=draw.randrange(9))) or "z", "t" * draw.randrange(60) or "z"] for k in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_ends_across_blocks(spark, tmp_path, small_blocks, end):
    data = _cells(400, 1)
    data[7][1] = "long\n" * 400  # one record over many blocks
    data[8][1] = '"quoted",\n"' * 150
    for name, rows in (("a.csv", data[:250]), ("b.csv", data[250:])):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=end)
        writer.writerows([["id", "text", "more"], *rows])
        (tmp_path / name).write_text(out.getvalue(), newline="")
    path = str(tmp_path / "*.csv")
    records = lines.quoted_records(spark, path)
    assert records.select("file", "block").distinct().count() > 20
    got = {r["id"]: (r["text"], r["more"]) for r in files.read_csv(spark, path, "id string, text string, more string").collect()}
    assert got == {i: (a, b) for i, a, b in data}
    numbered = lines.source_ids(lines.quoted_records(spark, path)).filter("NOT (block = 0 AND row = 0)").orderBy("id").collect()
    ids = [next(csv.reader(io.StringIO(r["text"])))[0] for r in numbered]
    assert ids == [str(k) for k in range(400)]


def test_places_are_dense_and_in_source_order(spark, tmp_path, small_blocks):
    for name, part in (("a.txt", range(300)), ("b.txt", range(300, 410))):
        (tmp_path / name).write_text("".join(f"line {k}\n" for k in part))
    numbered = lines.source_ids(lines.numbered_lines(spark, str(tmp_path)), start=1)
    assert {r["id"]: r["value"] for r in numbered.collect()} == {k + 1: f"line {k}" for k in range(410)}


@pytest.mark.parametrize(
    "text, inside, behind",
    [
        ("a,b", False, False), ('a,"b', False, True), ('"a""b",c', False, False), ('"a""', False, True), ('x,5" pipe,"', False, True),
        ('b",c', True, False), ("b,c", True, True), ('"', True, False), ('""', True, True), ('",""x"', True, False), ("", True, True),
    ],
)
def test_quote_state_behind_a_line(text, inside, behind):
    assert lines.ends_inside(text, inside) is behind


def test_state_of_blocks_is_that_of_one_reading(spark, tmp_path, small_blocks):
    """Blocks compose: settled ones, ones that turn the state over and ones that keep it."""
    out = io.StringIO()
    csv.writer(out).writerows([["id", "text"], *([str(k), 'x"\n' * (k % 40)] for k in range(300))])
    (tmp_path / "a.csv").write_text(out.getvalue(), newline="")
    text, state, open_at, at = out.getvalue(), False, set(), 0
    begins = {r["block"] for r in lines.numbered_lines(spark, str(tmp_path)).select("block").distinct().collect()}
    first_line = {}
    for line in text.split("\n")[:-1]:
        # a block's first line is the first that begins behind the block's first byte
        for b in [b for b in begins if b not in first_line and (at > b or at == b == 0)]:
            first_line[b] = state
        state = lines.ends_inside(line, state)
        at += len(line.encode()) + 1
    open_at = {b for b, s in first_line.items() if s}
    found = {r["block"] for r in lines.open_blocks(lines._lines(spark, str(tmp_path), "\n")).collect()}
    assert found == open_at and open_at


def test_csv_rejects(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text('n,t\n1,a\nx,b\n3\n4,"c\nd"\n5,e,f\n\n')
    good, bad = files.read_csv_checked(spark, str(tmp_path), "n int, t string")
    assert rows(good, "row", "n", "t") == [(1, 1, "a"), (4, 4, "c\nd")]
    assert rows(bad, "row", "text") == [(2, "x,b"), (3, "3"), (5, "5,e,f")]
    assert bad.first()["reason"]


def test_json_rejects(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text('{"n": 1}\n{"n": \n\n{"n": "x"}\n{"n": 4, "m": 2}\n')
    good, bad = files.read_json_lines_checked(spark, str(tmp_path), "n int")
    assert rows(good, "row", "n") == [(0, 1), (4, 4)]
    assert rows(bad, "row", "text") == [(1, '{"n": '), (3, '{"n": "x"}')]
    assert rows(files.read_json_lines(spark, str(tmp_path), "n int")) == [(1,), (4,)]
    assert rows(files.read_json_lines(spark, str(tmp_path), "n int", source=True), "row", "n") == [(0, 1), (4, 4)]


def test_files_open_inside_quotes_are_read_whole(spark, rows, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(lines, "MAX_OPEN_BLOCKS", 0)
    (tmp_path / "a.csv").write_text('n,t\n1,"' + "x\n" * 500 + '"\n')
    assert files.read_csv(spark, str(tmp_path), "n int, t string").first()["t"] == "x\n" * 500
    with pytest.raises(ValueError):
        files.read_csv_checked(spark, str(tmp_path), "n int, t string")


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n")
    assert files.read_csv(spark, str(tmp_path), "n int, t string").filter(F.col("n") > 0).collect() == []
    assert lines.source_ids(lines.numbered_lines(spark, str(tmp_path))).count() == 1
