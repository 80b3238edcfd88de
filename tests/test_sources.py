from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from weftline.plans import recipes
from weftline.sinks import files as sinks
from weftline.sources import commits, files, mail, pages
from weftline.storage import materialize, path_exists


def test_csv_keeps_quotes_and_line_ends(spark, rows, tmp_path):
    data = [("1", 'a "q", b\nnext', "x"), ("2", "back\\slash", None)]
    df = spark.createDataFrame(data, "id string, text string, label string")
    sinks.write_csv(df, str(tmp_path / "c"), ["label", "id", "text"])
    back = files.read_csv(spark, str(tmp_path / "c"), "label string, id string, text string")
    assert rows(back, "id", "text", "label") == sorted(data, key=repr)


def test_csv_columns_go_by_name(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("label,extra,text\nx,1,first\ny,2,second\n")
    back = files.read_csv(spark, str(tmp_path / "a.csv"), "text string, label string, missing int")
    assert rows(back) == [("first", "x", None), ("second", "y", None)]


def test_json_sources(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"instruction": "i", "output": ""}, {"instruction": "j"}], indent=1))
    df = files.read_json_array(spark, str(tmp_path / "a.json"), "instruction string, output string")
    assert rows(df) == [("i", ""), ("j", None)]
    lines = str(tmp_path / "l")
    sinks.write_json_lines(df, lines)
    sinks.append_json_lines(df.limit(1), lines)
    assert files.read_json_lines(spark, lines, "instruction string").count() == 3


def test_parquet_and_classes(spark, tmp_path):
    df = spark.range(10_001).withColumn("class", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    sinks.write_parquet(df, str(tmp_path / "p"))
    assert files.read_parquet(spark, str(tmp_path / "p")).count() == 10_001
    assert list((tmp_path / "p").glob("*.zstd.parquet"))
    sinks.write_per_class(df, str(tmp_path / "k"), "class")
    assert {p.name for p in (tmp_path / "k").iterdir() if p.is_dir()} == {"class=a", "class=b"}
    assert sinks.to_driver(df.limit(5)).num_rows == 5
    with pytest.raises(ValueError, match="rows"):
        sinks.to_driver(df, max_rows=100)
    with pytest.raises(ValueError, match="bytes"):
        sinks.to_driver(df, max_bytes=1000)


def test_scans(spark, rows):
    df = spark.range(25)
    seen, cursor = [], None
    while page := [r["id"] for r in files.keyset_page(df, "id", 10, cursor).collect()]:
        seen, cursor = seen + page, page[-1]
    assert seen == list(range(25))
    assert rows(files.fetch_by_ids(df, spark.createDataFrame([(3,), (99,)], "id long"), "id")) == [(3,)]
    assert rows(files.take_first(df, "id", 2)) == [(0,), (1,)]
    days = spark.createDataFrame([("2024-02-29",), ("2024-03-01",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    assert files.date_slice(days, "d", "2024-03-01").count() == 1


def test_stage_cache(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "stage")
    assert materialize(spark, path, build).count() == 3 == materialize(spark, path, build).count()
    assert len(calls) == 1
    (tmp_path / "stage" / "_SUCCESS").unlink()
    materialize(spark, path, build)
    assert len(calls) == 2 and path_exists(spark, path)


LOG = """h1;Ann;a@x;Sun Dec 31 23:30:00 2023 -0500;fix; really; all
h2;Bob;b@x;Mon Jan 1 10:00:00 2024 +0000;caf\xe9

h3;Semi;Colon;c@x;Mon Jan 1 10:00:00 2024 +0000;msg
h4;short"""


def test_commit_log(spark, rows, tmp_path):
    (tmp_path / "one.log").write_text(LOG, encoding="latin-1")
    (tmp_path / "two.log").write_text(LOG.splitlines()[0], encoding="latin-1")
    good, rejects = commits.read_commit_log(spark, str(tmp_path))
    assert rows(good, "repo", "hash", "date", "message") == [
        ("one", "h1", "2023-12-31", "fix; really; all"),
        ("one", "h2", "2024-01-01", "caf\xe9"),
        ("two", "h1", "2023-12-31", "fix; really; all"),
    ]
    assert rows(rejects, "reason") == [("bad date",), ("missing fields",), ("missing fields",)]
    ids = recipes.commit_collection(good)
    assert sorted(r["id"] for r in ids.collect()) == [1, 2, 3]


def test_page_envelopes(spark, rows, tmp_path):
    one = {"results": [{"document_number": "1", "abstract": " ", "title": " T ", "agencies": [{"name": "A"}, {}], "topics": ["x", "y"], "publication_date": "2024-01-02"}]}
    two = {"results": [{"id": "7", "abstract": "abs", "agencies": None}, {"document_number": "3", "abstract": "", "title": None}]}
    for name, page in (("1", one), ("2", two), ("3", {"results": []})):
        (tmp_path / f"{name}.json").write_text(json.dumps(page, indent=1))
    docs = pages.read_pages(spark, str(tmp_path), pages.REGISTER_PAGE, "results")
    got = recipes.register_records(docs)
    assert rows(got, "id", "text", "agency_names", "topics") == [("1", "T", "A, ", "x, y"), ("7", "abs", "", "")]


def test_last_user_wins(spark, rows, tmp_path):
    for name, mail_ in (("1", "old@x"), ("2", "new@x")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"content": {"users": [{"id": 5, "email": mail_}]}}))
    users = pages.read_pages(spark, str(tmp_path), pages.USER_PAGE, "content.users", load_order="seq")
    tickets = spark.createDataFrame([(5, 5, None, None)], "requester_id bigint, submitter_id bigint, assignee_id bigint, organization_id bigint")
    out = recipes.ticket_table(tickets, users, spark.createDataFrame([], "id bigint, name string"))
    assert rows(out, "requester_email", "assignee_email") == [("new@x", None)]


def test_page_chain(spark, rows):
    df = spark.createDataFrame([(None, ("b",)), ("b", ("c",)), ("d", (None,))], "asked string, records struct<cursor:string>")
    assert rows(pages.missing_pages(df, "asked", "records.cursor")) == [("c",)]


ARCHIVE = """Message-ID: <{n}@x>
Date: Mon, 14 May 2001 16:39:5{n} -0700 (PDT)
From: ann@firm.com
To: bob@firm.com
X-Origin: Ann-A
X-Origin: second

J\xf6rg wrote this"""


def test_mail_archive(spark, tmp_path):
    deep = tmp_path / "maildir" / "ann-a" / "sent items" / "old"
    deep.mkdir(parents=True)
    for n in (9, 5):
        (deep / f"{n}.").write_text(ARCHIVE.format(n=n), encoding="latin-1")
    (tmp_path / "maildir" / "bob-b").mkdir()
    (tmp_path / "maildir" / "bob-b" / "1.").write_text("From: nobody\nDate: bad\n\nhi")
    got = mail.read_mail_files(spark, str(tmp_path))
    r = got.filter("`Message-ID` = '<5@x>'").first()
    assert (r["_user"], r["_folder"], r["_filename"]) == ("ann-a", "sent items/old", "maildir/ann-a/sent items/old/5.")
    assert r["_text"] == "J\xf6rg wrote this" and r["X-Origin"] == "Ann-A" and r["Cc"] is None
    assert r["timestamp"] == datetime(2001, 5, 14, 23, 39, 55)
    once = {x["text"]: x for x in recipes.mail_collection(got).collect()}
    kept = once["J\xf6rg wrote this"]
    assert kept["copies"] == 2 and kept["Message-ID"] == "<5@x>" and kept["from-domain"] == "firm.com"
    other = once["hi"]
    assert other["from-domain"] == "" and other["To"] == "" and other["Subject"] is None and other["folder"] == ""


BOX = b"""From 1@xxx Mon Jan 01 00:00:00 2024
X-GM-THRID: 77
X-Gmail-Labels: Inbox,Category Updates,IMAP_$Forwarded,Mine
Message-ID: <1@b>
Subject: =?utf-8?q?caf=C3=A9?= plain
From: Ann <a@b>
Date: Mon, 1 Jan 2024 10:00:00 +0200
Content-Type: multipart/mixed; boundary="m"

--m
Content-Type: text/plain
Content-Disposition: attachment; filename="a.txt"

attached
--m
Content-Type: text/html; charset="utf-8"

<p>html <b>first</b></p>
--m
Content-Type: text/plain; charset="latin-1"
Content-Transfer-Encoding: 8bit

plain \xe9 wins
>From here
--m--

From 2@xxx Mon Jan 01 00:00:00 2024
References: <0@b>
Message-ID: <2@b>
Date: nonsense
Received: by x; Tue, 2 Jan 2024 03:04:05 -0800
Content-Type: multipart/alternative; boundary="m"

--m
Content-Type: text/html

<script>x</script>
--m
Content-Type: text/html

<p>second&nbsp;shows</p>
--m--

From 3@xxx Mon Jan 01 00:00:00 2024
Message-ID: <3@b>
In-Reply-To: <2@b>
Content-Type: text/html; charset="nowhere"

<i>raw</i>

From 4@xxx Mon Jan 01 00:00:00 2024
Message-ID: <4@b>
Content-Type: application/pdf

x
"""


def test_mailbox(spark, tmp_path):
    (tmp_path / "m.mbox").write_bytes(BOX)
    got = {r["message_id"]: r for r in mail.read_mbox(spark, str(tmp_path / "m.mbox")).collect()}
    one, two, three, four = (got[f"<{i}@b>"] for i in (1, 2, 3, 4))
    assert one["body"].strip() == "plain \xe9 wins\n>From here"
    assert one["thread_id"] == "77" and one["subject"] == "caf\xe9  plain" and one["to"] == ""
    assert one["date"] == datetime(2024, 1, 1, 8, 0)
    flags = {n for n in mail.MAILBOX_LABELS if one[n] == "True"}
    assert flags == {"Inbox", "Category_Updates", "IMAP_Forwarded"}
    assert two["body"] == "second shows" and two["thread_id"] == "<0@b>"
    assert two["date"] == datetime(2024, 1, 2, 3, 4, 5)
    assert three["thread_id"] == "<2@b>" and three["body"].strip() == "<i>raw</i>" and three["date"] is None
    assert four["body"] == "" and four["thread_id"] == "<4@b>"
    assert len(got) == 4


def test_calls(spark):
    t = spark.createDataFrame(
        [
            ("c1", [("s1", "intro", [(0, 5, "hi"), (5, 10, "all")]), ("s9", None, [(10, 40, "bye")])]),
            ("c2", [("s1", None, [(0, 0, "x")])]),
            ("c3", []),
        ],
        "callId string, transcript array<struct<speakerId:string,topic:string,sentences:array<struct<start:bigint,end:bigint,text:string>>>>",
    )
    party = "array<struct<speakerId:string,name:string,emailAddress:string,affiliation:string>>"
    meta = "struct<id:string,title:string,started:string,url:string>"
    calls = spark.createDataFrame(
        [
            (0, ("c1", "One", "d", "u"), [("s1", "Old", None, "In"), (None, "Ghost", None, "Out")]),
            (1, ("c2", "Two", "d", "u"), [("s1", "New", "n@x", "In")]),
            (2, None, [("s9", "Hidden", None, "Out")]),
        ],
        f"seq int, metaData {meta}, parties {party}",
    )
    got = {(r["call_id"], r["pos"]): r for r in recipes.enriched_calls(t, calls).collect()}
    assert len(got) == 3
    first, second = got["c1", 0], got["c1", 1]
    assert first["utterance"] == "hi\nall" and first["relative_end"] == 0.25 and first["speaker_name"] == "New"
    assert second["relative_end"] == 1.0 and second["speaker_name"] is None and second["call_title"] == "One"
    assert got["c2", 0]["relative_end"] is None


def test_tickets(spark, rows):
    tickets = spark.createDataFrame(
        [("u", 1, "d", "t", "s", "x", 5, 5, None, 9)],
        "url string, id bigint, created_at string, type string, subject string, description string, "
        "requester_id bigint, submitter_id bigint, assignee_id bigint, organization_id bigint",
    )
    users = spark.createDataFrame([(5, "a@x")], "id bigint, email string")
    orgs = spark.createDataFrame([(9, "Org")], "id bigint, name string")
    out = recipes.ticket_table(tickets, users, orgs)
    assert rows(out) == [("u", 1, "d", "t", "s", "x", "a@x", "a@x", None)]
    assert "Org" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_newsletter(spark):
    n = 22
    def line(url, name, *posts):
        row = [None] * n
        row[0], row[5] = url, name
        for i, post in zip(range(2, 21, 4), posts):
            for j, v in enumerate(post):
                if i + j != 5:
                    row[i + j] = v
        return row
    data = [
        (0, *line("https://a.s.com", "Old", ("p0", "t", "s"))),
        (1, *line(" https://a.s.com ", " A ", ("p1 ", " t ", None), ("", "gone", ""), (None, "gone", ""))),
        (2, *line("https://b.s.com", None, ("p2", None, "s"))),
        (3, *line(None, "none", ("p3", "t", "s"))),
    ]
    sheet = spark.createDataFrame(data, "line int, " + ", ".join(f"c{i} string" for i in range(n)))
    got = sorted(tuple(r) for r in recipes.newsletter_posts(sheet).select("id", "name", "url", "text").collect())
    assert got == [(0, "A", "p1", "t \n "), (1, None, "p2", " \n s")]


def test_proceedings(spark):
    df = spark.createDataFrame(
        [(1, "", "Ann", "1987", "keep"), (0, "abs", None, "bad", "x")], "n int, abstract string, authors string, year string, extra string"
    )
    got = recipes.proceedings(df, ["n"]).orderBy("id").collect()
    assert got[0]["abstract"] == "abs" and got[0]["authors"] == "N/A" and got[0]["year"] is None
    assert got[1]["abstract"] == "N/A" and got[1]["year"] == 1987.0 and got[1]["id"] == "1" and got[1]["title"] == "N/A"
    assert got[0].asDict().keys() == set(recipes.PROCEEDINGS_COLUMNS)


def test_comments(spark):
    data = [("a", None, "root", "ann", 1, 0.0), ("b", "a", "re", None, 2, 60.5), ("c", "b", "re re", "bob", 3, 61.0), ("d", None, "other", "x", 0, 1.0)]
    df = spark.createDataFrame(data, "id string, parent_id string, body string, author string, score long, created_utc double")
    got = {r["id"]: r for r in recipes.comment_rows(df).collect()}
    assert len(got) == 4 and {k: v["depth"] for k, v in got.items()} == {"a": 0, "b": 1, "c": 2, "d": 0}
    assert got["b"]["author"] == "[deleted]" and got["b"]["created_at"] == datetime(1970, 1, 1, 0, 1, 0, 500000)


def test_papers_of_event_pages(spark, rows):
    event = "<strong><a href='/p1'>1</a><a href='p2'>2</a></strong><a href='/no'>n</a><strong><a href='/p3'>3</a></strong>"
    paper = "<h2 id=title><a href=x>On  &amp; off</a></h2><p class=lead><a>Ann</a> <a>Bob</a></p><dl><dt>Year:</dt><dd>2020</dd></dl>"
    df = spark.createDataFrame(
        [("https://s.org/events/conf", event), ("https://s.org/p1", paper), ("https://s.org/events/p2", "<p>empty</p>")], "url string, html string"
    )
    from weftline.functions import html, text, urls

    hub = df.filter(text.contains_all(F.col("url"), "conf", "event"))
    edges = hub.select("url", F.explode(html.strong_hrefs(F.col("html"))).alias("href")).select(
        F.col("url").alias("src"), urls.resolve(F.col("url"), F.col("href")).alias("dst")
    )
    good, bad = recipes.event_papers(df, edges)
    r = good.first()
    assert (r["title"], r["authors"], r["year"], r["link"]) == ("On & off", ["Ann", "Bob"], "2020", None)
    assert rows(bad) == [("https://s.org/events/p2", "no title"), ("https://s.org/p3", "no page")]
    assert recipes.page_links(df).filter("href = '/no'").first()["dst"] == "https://s.org/no"


def test_vector_store(spark, rows):
    store = spark.createDataFrame(
        [("A", "1", [1.0], {"t": "x", "n": "5"}), ("B", "2", [2.0], {})], "class string, id string, vector array<float>, properties map<string,string>"
    )
    assert rows(recipes.class_table(store, "A", ["t"])) == [("1", [1.0], "x")]
    assert recipes.class_table(store, "C", ["t"]).count() == 0
    q = spark.createDataFrame([("i1", "b", [1.0])], "_id string, body string, title_embedding array<float>")
    assert recipes.embedded_questions(q).columns == ["body", "record_id", "embedding"]


def test_document_chunks(spark):
    df = spark.createDataFrame([("T", "f1", "# H\nbody\n"), ("U", "f2", "x")], "title string, filename string, text string")
    got = sorted(tuple(r) for r in recipes.document_chunks(df).collect())
    assert got == [(0, "# H\nbody\n", "T", "f1", "H", 1), (1, "x", "U", "f2", None, 1)]


def test_messages_are_parsed_a_few_at_a_time():
    import pyarrow as pa

    raw = [b"Subject: x\n\n" + b"a" * n for n in (10, mail.PARSED_AT_ONCE + 5, 0, mail.PARSED_AT_ONCE // 2, mail.PARSED_AT_ONCE, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(raw, pa.binary())], ["k", "content"])
    parts = [b.column(0).to_pylist() for b in mail._few(batch, "content")]
    assert parts == [[0], [1], [2, 3], [4], [5]] and [k for p in parts for k in p] == list(range(6))
    assert [b.num_rows for b in mail._few(batch.slice(0, 0), "content")] == [0]


def test_headers_alone_equal_those_of_whole_messages(spark, rows):
    raw = [b"", b"A: 1\na: 2\nA: 3\n\nbody\nB: 4", b"no header", b"C: x\n y\nnot one\n\nz", b"D: \xe9\r\n\r\n--b", b"\n\nE: 1",
           b'Content-Type: multipart/mixed; boundary="b"\nF: 1\n\n--b\nG: 2\n\nx\n--b--\n', b"From x\nH: 1\n\n"]
    df = spark.createDataFrame([(k, bytearray(r)) for k, r in enumerate(raw)] + [(99, None)], "k int, content binary")
    plain = [F.col("k"), F.array_sort(F.map_entries("headers")).alias("h")]
    alone, whole = (rows(f(df, "content").select(*plain)) for f in (mail.parse_headers, mail.parse_archived))
    assert alone == whole and len(alone) == len(raw)


def test_many_mail_files_are_few_tasks(spark, tmp_path):
    for k in range(1500):
        folder = tmp_path / "mail" / f"u{k % 3}" / "in"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{k}").write_bytes(b"From: a@b.example\n\nx%d" % k)
    found = mail.read_mail_files(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= mail.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert sorted(r["_text"] for r in found.select("_text").collect()) == sorted(f"x{k}" for k in range(1500))


def test_a_file_per_row_stands_where_spark_puts_it(spark, tmp_path, monkeypatch):
    """The folders and texts of Spark's writer, also for odd values, without a second file or a process for each row."""
    odd = ["a", "", None, "a/b", "x=1", "50%", "é ü", "#'\"[]{}^*:?\\", "\t\x7f", ".", "A"]
    data = [(u, f, t) for u in odd[:4] for f in odd for t in ("x\ny", "", None, "x\ny")]
    df = spark.createDataFrame(data, "user string, folder string, value string").repartition(3)
    df.write.partitionBy("user", "folder").option("maxRecordsPerFile", 1).text(str(tmp_path / "spark"))
    sinks.write_text_per_row(df, str(tmp_path / "own"), "value", ["user", "folder"])

    def found(top):
        return sorted((str(p.parent.relative_to(top)), p.read_text()) for p in top.rglob("part-*"))

    assert found(tmp_path / "own") == found(tmp_path / "spark") and len(found(tmp_path / "own")) == len(data)
    assert sum(p.is_file() for p in (tmp_path / "own").rglob("*")) == len(data)
    with monkeypatch.context() as patch:  # a store of another scheme is left to Spark
        patch.setattr(sinks, "hadoop_folder", lambda spark, path: (None, SimpleNamespace(getUri=lambda: SimpleNamespace(getScheme=lambda: "hdfs"))))
        sinks.write_text_per_row(df, str(tmp_path / "other"), "value", ["user", "folder"])
    assert found(tmp_path / "other") == found(tmp_path / "own")
    sinks.write_text_per_row(df.limit(0), str(tmp_path / "none"), "value", ["user", "folder"])
    assert mail.read_mail_files(spark, str(tmp_path / "none")).count() == 0


def test_a_mail_archive_is_one_file_a_message(spark, tmp_path):
    """No checksum file, and so no two processes, for each message; equal messages are files of their own."""
    import __spark_entry__ as entry

    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(folder.glob("archive-*"))
    data = [(k, f"s{k % 3}", f"l{k % 2}") for k in range(60)] + [(60, None, "l0"), (61, "s0", None), (62, "s/=%", "l0")]
    spark.createDataFrame(data, "doc_id long, source string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in entry.queries()["mail_files"](spark, str(tmp_path)).collect()}
    assert {r for r in got if r[0] != "user=__HIVE_DEFAULT_PARTITION__" and "_DEFAULT_" not in r[1]} == {
        *((f"user=l{u}", f"folder=s{s}", f"l{u}@mail.example", f"s{s}\n", 10) for u in (0, 1) for s in (0, 1, 2)),
        ("user=l0", "folder=s%2F%3D%25", "l0@mail.example", "s/=%\n", 1),
    }
    assert sum(r[-1] for r in got) == 63
    (archive,) = set(folder.glob("archive-*")) - before
    assert sum(p.is_file() for p in archive.rglob("*")) == 63
