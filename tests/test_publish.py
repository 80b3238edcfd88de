from __future__ import annotations

import pytest

from weftline.sinks import publish as keyed
from weftline.sinks.publish import compact, publish, read_published
from weftline.streaming.ingest import ingest, read_rejects


def table(spark, data):
    return spark.createDataFrame(data, "id int, v string")


def test_append_keeps_known_ids(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    publish(table(spark, [(1, "a"), (2, "b")]), path, "id")
    publish(table(spark, [(2, "new"), (3, "c")]), path, "id")
    assert rows(read_published(spark, path, "id")) == [(1, "a"), (2, "b"), (3, "c")]


def test_upsert_twice_is_upsert_once(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    publish(table(spark, [(1, "a"), (2, "b")]), path, "id")
    want = [(1, "a"), (2, "B"), (3, "c")]
    for batch in (1, 1, 2):
        publish(table(spark, [(2, "B"), (3, "c")]), path, "id", "upsert", batch)
        assert rows(read_published(spark, path, "id")) == want
    compact(spark, path, str(tmp_path / "u"), "id")
    assert rows(read_published(spark, str(tmp_path / "u"), "id"), "id", "v") == want


def test_replace(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    publish(table(spark, [(1, "a")]), path, "id")
    publish(table(spark, [(2, "b")]), path, "id", "upsert")
    publish(table(spark, [(9, "z")]), path, "id", "replace")
    assert rows(read_published(spark, path, "id")) == [(9, "z")]


@pytest.mark.parametrize("data", [[(1, "a"), (1, "b")], [(None, "a")]])
def test_bad_ids_are_refused(spark, rows, tmp_path, data):
    path = str(tmp_path / "t")
    publish(table(spark, [(1, "a")]), path, "id")
    with pytest.raises(ValueError):
        publish(table(spark, data), path, "id")
    assert rows(read_published(spark, path, "id")) == [(1, "a")]
    with pytest.raises(ValueError):
        publish(table(spark, [(5, "a")]), path, "id", "merge")


def test_daily_ingest(spark, rows, tmp_path):
    landing, target, check = (str(tmp_path / n) for n in ("landing", "table", "check"))

    def run():
        ingest(spark, landing, "id int, v string", target, "id", check, fmt="json", order_by=["v"], max_files=1).awaitTermination()

    table(spark, [(1, "a"), (2, "b"), (2, "c")]).coalesce(1).write.json(landing)
    run()
    assert rows(read_published(spark, target, "id")) == [(1, "a"), (2, "c")]
    run()
    table(spark, [(2, "again"), (3, "d")]).coalesce(1).write.mode("append").json(landing)
    run()
    assert rows(read_published(spark, target, "id")) == [(1, "a"), (2, "c"), (3, "d")]


def test_repeats_in_a_stream(spark, tmp_path):
    landing, target, check = (str(tmp_path / n) for n in ("landing", "table", "check"))
    df = spark.sql("SELECT id % 5 AS id, timestamp'2024-01-01' + make_interval(0, 0, 0, 0, id) AS at FROM range(20)")
    df.write.parquet(landing)
    ingest(spark, landing, df.schema, target, "id", check, max_files=1).awaitTermination()
    assert read_published(spark, target, "id").count() == 5


def test_late_rows_with_new_ids_are_taken(spark, tmp_path):
    landing, target, check = (str(tmp_path / n) for n in ("landing", "table", "check"))
    for day, ids in (("2024-01-20", "1, 2"), ("2024-01-10", "3, 4")):
        df = spark.sql(f"SELECT explode(array({ids})) AS id, timestamp'{day}' AS at")
        df.write.mode("append").parquet(landing)
        ingest(spark, landing, df.schema, target, "id", check, max_files=1).awaitTermination()
    assert read_published(spark, target, "id").count() == 4


def test_a_later_batch_adds_a_column(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), path, "id")
    publish(spark.createDataFrame([(2, "c", 7)], "id int, v string, w int"), path, "id", "upsert")
    found = {r["id"]: (r["v"], r["w"]) for r in read_published(spark, path, "id").collect()}
    assert found == {1: ("a", None), 2: ("c", 7)}
    with pytest.raises(ValueError, match="bucket"):
        publish(spark.createDataFrame([(1, 2)], "id int, bucket int"), path, "id")


def test_reads_do_not_shuffle_and_upserts_leave_other_buckets(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(1000).selectExpr("cast(id AS int) AS id", "'old' AS v"), path, "id", buckets=32)
    before = keyed._pointer(spark, path, 0)["live"]
    publish(table(spark, [(7, "new"), (2000, "new")]), path, "id", "upsert")
    plan = read_published(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    after = keyed._pointer(spark, path, 1)["live"]
    assert sum(before[b][0] in after[b] for b in before) == 31  # one bucket shares an id
    found = dict(rows(read_published(spark, path)))
    assert len(found) == 1001 and found[7] == found[2000] == "new" and found[8] == "old"
    publish(table(spark, [(8, "newer")]), path, "id", "upsert")
    assert len(list((tmp_path / "t").glob("rows-*"))) <= 5  # what no pointer names is deleted
    assert dict(rows(read_published(spark, path)))[8] == "newer"


def test_a_publish_that_dies_leaves_the_table(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(table(spark, [(1, "a"), (2, "b")]), path, "id")
    for mode in ("append", "upsert", "replace"):
        with monkeypatch.context() as patch:
            patch.setattr(keyed, "_point", lambda *args: (_ for _ in ()).throw(OSError("killed")))
            with pytest.raises(OSError):
                publish(table(spark, [(2, "x"), (3, "x")]), path, "id", mode)
        assert rows(read_published(spark, path)) == [(1, "a"), (2, "b")]
    publish(table(spark, [(3, "c")]), path, "id")
    assert rows(read_published(spark, path)) == [(1, "a"), (2, "b"), (3, "c")]
    assert len(list((tmp_path / "t").glob("rows-*"))) == 2


def test_ids_of_another_type_meet(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), path, "id")
    publish(spark.createDataFrame([(2, "c")], "id int, v string"), path, "id", "upsert")
    publish(table(spark, []), path, "id", "upsert")
    assert rows(read_published(spark, path)) == [(1, "a"), (2, "c")]
    publish(table(spark, []), path, "id", "replace")
    assert read_published(spark, path).collect() == [] and read_published(spark, path).columns == ["id", "v"]
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "none"))


def test_a_changed_repeat_replaces_its_batch(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    publish(table(spark, [(1, "a")]), path, "id", batch=0)
    publish(table(spark, [(1, "b"), (2, "b")]), path, "id", "upsert", batch=1)
    publish(table(spark, [(3, "c")]), path, "id", "upsert", batch=1)
    assert rows(read_published(spark, path)) == [(1, "a"), (3, "c")]


def test_ingest_goes_on_past_bad_rows(spark, rows, tmp_path):
    landing, target, check = (str(tmp_path / n) for n in ("landing", "table", "check"))
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text('{"id": 1, "v": "a"}\n{"id": 2, "v"\n{"id": null, "v": "n"}\n{"id": "x", "v": "t"}\n')

    def run():
        ingest(spark, landing, "id int, v string", target, "id", check, fmt="json", max_files=1).awaitTermination()

    run()
    (tmp_path / "landing" / "b.json").write_text('{"id": 1, "v": "again"}\n{"id": 3, "v": "c"}\nnothing\n')
    for _ in range(2):
        run()
    assert rows(read_published(spark, target)) == [(1, "a"), (3, "c")]
    bad = rows(read_rejects(spark, f"{target}-rejects"), "batch", "reason", "row")
    assert [r[:2] for r in bad] == [(0, "does not parse")] * 2 + [(0, "no id"), (1, "does not parse")]
    assert bad[3][2] == "nothing" and '"v":"n"' in bad[2][2]


def test_ingest_of_csv_keeps_rejects(spark, rows, tmp_path):
    landing, target, check = (str(tmp_path / n) for n in ("landing", "table", "check"))
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.csv").write_text('id,v\n1,a\n,b\nx,c\n2,"d, e"\n')
    ingest(spark, landing, "id int, v string", target, "id", check, fmt="csv", transform=lambda df: df.selectExpr("id", "upper(v) AS v")).awaitTermination()
    assert rows(read_published(spark, target)) == [(1, "A"), (2, "D, E")]
    assert [r.reason for r in read_rejects(spark, f"{target}-rejects").orderBy("reason").collect()] == ["does not parse", "no id"]
