from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from weftline.functions import dates, html, text, urls, vectors

def c():
    return F.col("c")


@pytest.mark.parametrize(
    "raw, want",
    [(" \t a b \n", "a b"), ("\xa0x　", "x"), ("", ""), ("\n\n", "")],
)
def test_strip(value, raw, want):
    assert value(text.strip(c()), c=raw) == want


def test_fallbacks(value):
    assert value(text.first_nonblank(F.col("a"), F.col("b")), a=" \n", b=" t ") == "t"
    assert value(text.first_nonblank(F.col("a"), F.col("b")), a=" ", b="") is None
    assert value(text.or_na(c()), c="") == "N/A"
    assert value(text.list_or_na(F.array().cast("array<string>"))) == "N/A"
    assert value(text.list_or_na(F.array(F.lit("a"), F.lit("b")))) == "a, b"
    assert value(text.bool_text(F.lit(True))) == "True"
    assert value(text.thread_id(F.lit(""), F.lit(None), F.lit("r"), F.lit("m"))) == "r"
    assert value(text.thread_id(F.lit("t"), F.lit("x"), F.lit("r"), F.lit("m"))) == "t"
    assert value(text.thread_id(F.lit(None).cast("string"), F.lit(None), F.lit(None), F.lit("m"))) == "m"
    assert value(text.deleted_author(F.lit(None).cast("string"))) == "[deleted]"


def test_paths_and_addresses(value):
    assert value(text.part_after_at(c()), c="a@b@c") == "b"
    assert value(text.part_after_at(c()), c="nobody") is None
    assert value(text.host_slug(c()), c="https://news.site.com/p") == "news"
    assert value(text.host_slug(c()), c="nothing") is None
    assert value(text.last_segment(c()), c="https://x/y/repo/ ".strip()) == "repo"
    assert value(text.file_stem(c()), c="/tmp/a_b_commits.csv") == "a_b_commits"
    assert value(text.file_stem(c()), c="/tmp/.hidden") == ".hidden"
    assert value(text.joined_sorted(F.array(F.lit("b"), F.lit("a")))) == "a_b"
    assert value(text.as_json(c()), c="é") == '{"c":"é"}'


def test_joined_names_keeps_missing(spark):
    df = spark.createDataFrame([([("a",), (None,)],)], "xs array<struct<name:string>>")
    assert df.select(text.joined_names(F.col("xs"), "name")).first()[0] == "a, "


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Mon, 14 May 2001 16:39:59 -0700 (PDT)", datetime(2001, 5, 14, 23, 39, 59)),
        ("Fri, 4 May 2001 13:51:05 -0700", datetime(2001, 5, 4, 20, 51, 5)),
        ("4 May 2001 13:51:05 EST", datetime(2001, 5, 4, 18, 51, 5)),
        ("4 May 2001 13:51:05", datetime(2001, 5, 4, 13, 51, 5)),
        ("some day", None),
        ("Fri, 44 May 2001 13:51:05 -0700", None),
        (None, None),
    ],
)
def test_mail_dates(value, raw, want):
    assert value(dates.mail_instant(F.lit(raw).cast("string"))) == want


def test_received_is_the_fallback(value):
    received = "by mx with SMTP id 1; Tue,  2 Jan 2024 03:04:05 -0800"
    both = dates.message_instant(F.col("d"), F.col("r"))
    assert value(both, d="bad", r=received) == datetime(2024, 1, 2, 3, 4, 5)
    assert value(dates.message_instant(F.lit(None).cast("string"), F.col("r")), r=received) == datetime(2024, 1, 2, 3, 4, 5)


def test_commit_day_is_the_authors(value):
    late = "Sun Dec 31 23:30:00 2023 -0500"
    assert value(dates.commit_day(c()), c=late) == date(2023, 12, 31)
    assert value(dates.commit_instant(c()), c=late) == datetime(2024, 1, 1, 4, 30)
    assert value(dates.commit_day(c()), c="31 Dec 2023") is None
    assert value(dates.commit_day(c()), c="Sun Feb 31 23:30:00 2023 -0500") is None


def test_job_dates(value):
    assert value(dates.day_before("2024-03-01")) == date(2024, 2, 29)
    assert value(dates.iso_date(c()), c="2024-02-30") is None
    with pytest.raises(ValueError):
        dates.checked_date("yesterday")


BASE = "https://a.org/venues/x/list.html?q=1#top"


@pytest.mark.parametrize(
    "link, want",
    [
        ("https://b.org/z", "https://b.org/z"),
        ("/p/1", "https://a.org/p/1"),
        ("next.html", "https://a.org/venues/x/next.html"),
        ("../y/", "https://a.org/venues/y/"),
        ("./a/./b/../c?d=../e", "https://a.org/venues/x/a/c?d=../e"),
        ("../../../../up", "https://a.org/up"),
        ("//c.org/d", "https://c.org/d"),
        ("?page=2", "https://a.org/venues/x/list.html?page=2"),
        ("#part", None),
        ("mailto:me@x.org", None),
        ("javascript:void(0)", None),
    ],
)
def test_resolve(value, link, want):
    assert value(urls.resolve(F.lit(BASE), c()), c=link) == want


def test_resolve_without_a_path(value):
    assert value(urls.resolve(F.lit("https://a.org"), c()), c="x") == "https://a.org/x"


PAGE = """<html><head><title>T &amp; U</title><script>var t="</p>";</script><style>p{}</style></head>
<body><!-- <a href="/hidden">no</a> --><h2 id="title"><a href="/t.pdf">A &lt;b&gt; Title</a></h2>
<p class="big lead"><a href="/p/ann">Ann</a>, <a href='/p/bob'>Bob</a></p>
<strong>see <a class=x href=/s1>one</a><a name="n">none</a></strong> <a href="#x">x</a>
<dl><dt>Year:</dt><dd>2023</dd><dt>URL:</dt><dd><a href="https://u.org/1">u</a></dd></dl>
caf&#233; &#x20AC;&nbsp;5 &amp;lt; &bogus; 2 &lt; 3</body></html>"""


def test_html(value):
    assert value(html.visible_text(c()), c=PAGE) == (
        "T & U A <b> Title Ann , Bob see one none x Year: 2023 URL: u café € 5 &lt; &bogus; 2 < 3"
    )
    assert value(html.first_block_text(c(), "title"), c=PAGE) == "T & U"
    assert value(html.first_block_text(c(), "h6"), c=PAGE) is None
    assert value(html.strong_hrefs(c()), c=PAGE) == ["/s1"]
    assert value(html.blocks_with_class(c(), "p", "lead"), c=PAGE) == [
        "<a href=\"/p/ann\">Ann</a>, <a href='/p/bob'>Bob</a>"
    ]
    assert value(html.labelled_block(c(), "Year:"), c=PAGE) == "2023"
    assert value(html.labelled_block(c(), "Venue:"), c=PAGE) is None
    assert value(html.hrefs(html.block_with_id(c(), "h2", "title")), c=PAGE) == ["/t.pdf"]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0, 0.0], [1.0, 0.0, 2.0], [0.0, 0.0, 1.0])], "a array<float>, b array<float>, z array<float>")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    row = df.select(
        vectors.dot(a, b).alias("dot"),
        vectors.norm(a).alias("norm"),
        vectors.distance(a, b).alias("far"),
        vectors.truncated(a, 2).alias("short"),
        vectors.truncated(z, 2).alias("zero"),
    ).first()
    assert row["dot"] == 3.0 and row["norm"] == 5.0
    assert row["far"] == pytest.approx(24**0.5)
    assert row["short"] == pytest.approx([0.6, 0.8]) and row["zero"] is None


def test_mail_dates_without_seconds_or_century(spark):
    from weftline.functions.dates import mail_instant

    data = [("Tue, 1 Jan 2002 10:20 +0000",), ("1 Jan 02 10:20:30 +0000",), ("1 Jan 99 10:20:30 +0000",)]
    got = spark.createDataFrame(data, "d string").select(mail_instant(F.col("d")).cast("long").alias("t")).collect()
    assert [r["t"] for r in got] == [1009880400, 1009880430, 915186030]


def test_links_and_text_step_over_scripts_comments_and_quotes(spark):
    from weftline.functions.html import hrefs, visible_text

    page = """<!-- <a href="/hidden">h</a> --><script>'<a href="/js">'</script><p title='a > b'>x</p><a href="/y">y</a>"""
    row = spark.createDataFrame([(page,)], "h string").select(hrefs(F.col("h")), visible_text(F.col("h"))).first()
    assert list(row) == [["/y"], "x y"]
    long = "<b " + "k=v " * 20_000
    assert spark.createDataFrame([(long,)], "h string").select(visible_text(F.col("h"))).first()[0] == long.strip()


def test_nested_and_open_elements(value):
    page = "<ul><li>a <b>x</b><ul><li class='in k'>b</li><li>c</li></ul></li><LI id=last>d <list>e</list><p>f</ul>"
    assert value(html.blocks(F.col("c"), "li"), c=page) == [
        "a <b>x</b><ul><li class='in k'>b</li><li>c</li></ul>", "b", "c", "d <list>e</list><p>f</ul>",
    ]
    assert value(html.blocks_with_class(F.col("c"), "li", "k"), c=page) == ["b"]
    assert value(html.block_with_id(F.col("c"), "li", "last"), c=page).startswith("d ")
    assert value(html.blocks(F.col("c"), "li"), c="</li>no<!-- <li>c</li> -->") == []
    strong = "<strong><a href=1></a><strong><a href='2'></a></strong></strong><a href=3></a><strong><a href=1></a></strong><strong><a href=1></a>"
    assert value(html.strong_hrefs(F.col("c")), c=strong) == ["1", "2", "1", "1"]
    labels = "<!-- <dt>Year:</dt><dd>0</dd> --><dl><dt>Year:</dt><dd>a<dl><dd>b</dd></dl>c</dd></dl>"
    assert value(html.labelled_block(F.col("c"), "Year:"), c=labels) == "a<dl><dd>b</dd></dl>c"


def test_all_named_references(value):
    assert value(html.unescape(F.col("c")), c="&oacute;&AMP;&amp;lt;&NotEqualTilde;&nosuch;&alpha;") == "ó&&lt;≂̸&nosuch;α"
