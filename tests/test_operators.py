from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.operators import census, clean, dedupe, enrich, ids, reshape, skew


def test_exact_dedupe_properties(spark, rows):
    data = [(3, "a", None, "x"), (1, "a", 5, None), (2, "a", 4, "y"), (4, "b", None, "z"), (5, None, 1, "w"), (6, None, 1, "v")]
    df = spark.createDataFrame(data, "id int, text string, at int, who string")
    once = dedupe.exact_dedupe(df, "text", ["at", "id"])
    assert rows(once, "text", "id", "who", "copies") == sorted(
        [("a", 2, "y", 3), ("b", 4, "z", 1), (None, 5, "w", 2)], key=repr
    )
    assert once.agg(F.sum("copies")).first()[0] == len(data)
    again = dedupe.exact_dedupe(once.drop("copies"), "text", ["at", "id"])
    assert rows(again.drop("copies")) == rows(once.drop("copies"))


def test_first_copy_keeps_its_null(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "late")], "id int, text string, who string")
    assert dedupe.exact_dedupe(df, "text", ["id"]).first()["who"] is None


def test_latest_by_key(spark, rows):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, None), ("j", 1, "x")], "k string, seq int, v string")
    assert rows(dedupe.latest_by_key(df, "k", ["seq"]), "k", "v") == [("j", "x"), ("k", None)]


def test_spread_join_equals_plain_join(spark, rows):
    many = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        F.col("id"),
    )
    one = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("absent", 4)], "k string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        by_row = skew.spread_join(many, one, "k", None, how, hot_rows=5)
        assert rows(by_row, *sorted(by_row.columns)) == rows(many.join(one, "k", how), *sorted(by_row.columns))
        salted = skew.spread_join(many, one, "k", "id", how, hot_rows=100)
        assert "_salt" in salted._jdf.queryExecution().toString() and "_salt" not in salted.columns
        assert rows(salted, *sorted(salted.columns)) == rows(many.join(one, "k", how), *sorted(salted.columns))
    assert [r[0] for r in skew.hot_keys_of(many, "k", 100).collect()] == ["hot"]
    assert skew.hot_keys_of(many, "k", 10**6) is None and skew.hot_keys_of(many, "k", 1, n_rows=0) is None
    assert skew.is_small(one, 4) and not skew.is_small(one, 3)


def test_lookup_keeps_rows_and_orphans_are_listed(spark, rows):
    tickets = spark.createDataFrame([(1, 10, 10, None), (2, 11, 99, 10)], "id int, requester int, submitter int, assignee int")
    users = spark.createDataFrame([(10, "a@x"), (11, "b@x")], "id int, email string")
    roles = {r: {"email": f"{r}_mail"} for r in ("requester", "submitter", "assignee")}
    for small_rows in (10, 0):
        out = enrich.lookup(tickets, users, "id", roles, small_rows)
        assert ("BroadcastHint" in str(out._jdf.queryExecution().logical()) or "hint" in str(out._jdf.queryExecution().logical()).lower()) == bool(small_rows)
    assert rows(out, "id", "requester_mail", "submitter_mail", "assignee_mail") == [
        (1, "a@x", "a@x", None),
        (2, "b@x", None, "a@x"),
    ]
    assert rows(enrich.orphans(tickets, users, "submitter", "id")) == [(99, 1)]
    assert rows(enrich.orphans(tickets, users, "assignee", "id")) == []


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_relative_position_uses_the_last_row(spark, rows, hot_rows):
    df = spark.createDataFrame(
        [("c", 0, 0, 90), ("c", 1, 20, 40), ("z", 0, 0, 5), ("z", 1, 5, 0)], "call string, pos int, s int, e int"
    )
    out = enrich.relative_position(df, "call", "pos", "s", "e", hot_rows)
    assert rows(out, "call", "pos", "relative_start", "relative_end") == [
        ("c", 0, 0.0, 2.25),
        ("c", 1, 0.5, 1.0),
        ("z", 0, None, None),
        ("z", 1, None, None),
    ]


def test_unaligned(spark, rows):
    a = spark.createDataFrame([(1,), (2,)], "id int")
    v = spark.createDataFrame([(2, [1.0]), (3, [1.0])], "id int, v array<double>")
    assert rows(enrich.unaligned(a, v, "id")) == [(1, 1, 0), (3, 0, 1)]
    assert rows(enrich.align_vectors(a, v, "id"), "id") == [(2,)]


def test_sequential_id_is_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    out = ids.sequential_id(df, ["k"], start=1).collect()
    assert sorted((r["k"], r["id"]) for r in out) == [(i, i + 1) for i in range(1000)]


def test_bad_ids(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    assert rows(ids.bad_ids(df, "id")) == [(1, 2), (None, 1)]


def test_label_flags(spark):
    labels = "Inbox, Category Updates,IMAP_$Forwarded,My own"
    df = spark.createDataFrame([(1, labels), (2, None), (3, "")], "id int, labels string")
    names = ["Inbox", "Spam", "Category_Updates", "IMAP_Forwarded"]
    got = {r["id"]: [r[n] for n in names] for r in reshape.label_flags(df, "labels", names).collect()}
    assert got == {1: [True, False, True, True], 2: [False] * 4, 3: [False] * 4}
    text = reshape.label_flags(df, "labels", names, as_text=True).orderBy("id").first()
    assert text["Inbox"] == "True" and text["Spam"] == "False"


def test_child_fields_win(spark):
    df = spark.createDataFrame([("n", "site", [("p1", "t")])], "name string, url string, posts array<struct<url:string,title:string>>")
    assert reshape.explode_records(df, "posts").first().asDict() == {"name": "n", "url": "p1", "title": "t"}


def test_text_properties(spark, rows):
    schema = "classes array<struct<class:string,properties:array<struct<name:string,dataType:array<string>>>>>"
    doc = spark.createDataFrame([([("A", [("t", ["text"]), ("n", ["int"]), ("m", ["text", "int"])]), ("B", [])],)], schema)
    assert rows(reshape.text_properties(doc)) == [("A", "t")]


def test_clean(spark, rows):
    df = spark.createDataFrame([("", [], 0.0, None), ("x", ["a", "b"], 2.0, 1)], "t string, l array<string>, year double, n int")
    assert rows(clean.fill_na(df, ["t", "l", "year"]), "t", "l", "year") == [("N/A", "N/A", 0.0), ("x", "a, b", 2.0)]
    assert clean.whitelist(df, ["year", "new"]).columns == ["year", "new"]
    assert rows(clean.with_value(df, "t", "n"), "t") == [("x",)]
    good, bad = clean.good_and_rejects(df, F.when(F.col("n").isNull(), "no n"))
    assert good.count() == 1 and rows(bad, "reason") == [("no n",)]


def test_archive_clamp_bounds(spark):
    stamps = ["1996-12-31 23:59:59", "1997-01-01 00:00:00", "2003-01-01 00:00:00", "2003-01-01 00:00:01", None]
    df = spark.createDataFrame([(s,) for s in stamps], "s string")
    out = [r[0] and str(r[0]) for r in df.select(clean.archive_clamp(F.col("s").cast("timestamp"))).collect()]
    default = "1997-01-01 01:00:00"
    assert out == [default, "1997-01-01 00:00:00", "2003-01-01 00:00:00", default, None]


def test_census(spark, rows):
    df = spark.createDataFrame([({"a": "1", "b": "2"},), ({"a": "3"},), (None,)], "h map<string,string>")
    assert [tuple(r) for r in census.common_keys(df, "h", 1).collect()] == [("a", 2)]
    assert rows(census.promote_keys(df, "h", ["b"]), "b") == sorted([("2",), (None,), (None,)], key=repr)
    ten = spark.range(100)
    one = rows(census.fixed_sample(ten, "id", 10, seed=1))
    assert len(one) == 10 and one == rows(census.fixed_sample(ten.repartition(5), "id", 10, seed=1))
    assert one != rows(census.fixed_sample(ten, "id", 10, seed=2))


def test_union_and_overlap(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(dedupe.union_all(a, b), "id", "a") == [(1, "x"), (1, None), (2, None)] or len(rows(dedupe.union_all(a, b))) == 3
    assert dedupe.overlap(a, b, "id").first()["shared"] == 1
    assert rows(dedupe.unvisited(b, a, "id")) == [(2,)]


def test_salts_follow_the_size_of_a_key(spark):
    """One key with half of the rows and 2,000 other hot keys: all are spread, each by its size."""
    many = spark.range(80_000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 0 ELSE 1 + id % 4000 END AS k")
    one = spark.range(5000).selectExpr("id AS k", "id * 2 AS v")
    hot = skew.hot_keys_of(many, "k", 20)
    salts = {r["k"]: r["_salts"] for r in hot.collect()}
    assert len(salts) == 2001 and salts.pop(0) == 2000 and set(salts.values()) == {1}
    joined = skew.spread_join(many, one, "k", "id", "inner", hot=skew.hot_keys_of(many, "k", 1000))
    assert joined.count() == 80_000 and joined.filter("v <> 2 * k").count() == 0
