"""Queries over landed files that are read in source order, with rejects; Spark writes the files from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import html
from weftline.operators import cells
from weftline.plans import recipes
from weftline.plans.catalog import query, table
from weftline.plans.catalog_vectors import _CORPUS_SQL, _MEANS_SQL, _ROUNDED_SQL, _corpus, _label_queries, _rounded, _top_sql
from weftline.sinks import files as sinks
from weftline.sinks import publish as keyed
from weftline.sources import files, lines, mail
from weftline.storage import scratch_path
from weftline.streaming import ingest as streaming

# The characters that `strip` drops and the tables hold, in DuckDB.
_BLANK = r"E' \t\n\x0B\f\r'"


@query(
    f"""
    WITH d AS (SELECT *, doc_id % 50 AS slug FROM documents),
    last AS (SELECT slug, min(doc_id) AS line, max(doc_id) AS doc_id FROM d GROUP BY slug),
    posts AS (
      SELECT line, 0 AS no, 'Letter ' || doc_id AS name, 'https://p.example/' || doc_id AS url,
             CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END || chr(32) || chr(10) || chr(32) || trim(text, {_BLANK}) AS text
      FROM last JOIN documents USING (doc_id)
      UNION ALL
      SELECT line, 2, 'Letter ' || doc_id, 'https://q.example/' || doc_id, lang || chr(32) || chr(10) || chr(32)
      FROM last JOIN documents USING (doc_id) WHERE doc_id % 2 = 1
    )
    SELECT row_number() OVER (ORDER BY line, no) - 1 AS id, name, url, text FROM posts
    """
)
def newsletter_posts(spark: SparkSession, d: str) -> DataFrame:
    """A sheet of newsletters with posts in groups of columns; texts hold line ends; slugs repeat."""
    path = scratch_path(spark, "sheet")
    none = F.lit(None).cast("string")
    own = {
        0: F.concat(F.lit("https://s"), (F.col("doc_id") % 50).cast("string"), F.lit(".letters.example/")),
        2: F.concat(F.lit(" https://p.example/"), F.col("doc_id").cast("string")),
        3: F.when(F.col("doc_id") % 3 != 0, F.col("source")),
        4: F.col("text"),
        5: F.concat(F.lit("Letter "), F.col("doc_id").cast("string"), F.lit(" ")),
        10: F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit("https://q.example/"), F.col("doc_id").cast("string"))),
        11: F.col("lang"),
    }
    sheet = table(spark, d, "documents").select("doc_id", *[own.get(k, none).alias(f"c{k:02}") for k in range(22)])
    sinks.write_csv(sheet.orderBy("doc_id"), path, [f"c{k:02}" for k in range(22)])
    return recipes.read_newsletter(spark, path, ", ".join(f"c{k:02} STRING" for k in range(22))).select("id", "name", "url", "text")


@query(
    """
    SELECT (row_number() OVER (ORDER BY doc_id) - 1)::VARCHAR AS id, coalesce(nullif(text, ''), 'N/A') AS abstract,
           source AS authors, 'N/A' AS title, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE (1980 + doc_id % 40)::DOUBLE END AS year
    FROM documents
    """
)
def proceedings(spark: SparkSession, d: str) -> DataFrame:
    """Papers in JSON lines, numbered by line."""
    path = scratch_path(spark, "papers")
    year = F.when(F.col("doc_id") % 7 == 0, "unknown").otherwise((1980 + F.col("doc_id") % 40).cast("string"))
    papers = table(spark, d, "documents").orderBy("doc_id").select(
        F.col("text").alias("abstract"), F.col("source").alias("authors"), F.lit("").alias("title"), year.alias("year"), F.lit("x").alias("extra")
    )
    sinks.write_json_lines(papers, path)
    fields = "abstract STRING, authors STRING, title STRING, year STRING"
    return recipes.read_proceedings(spark, path, fields).select("id", "abstract", "authors", "title", "year")


@query(
    r"""
    WITH c AS (
      SELECT doc_id, i, chunks[i + 1] AS text, CASE WHEN i < n_head THEN 'Part ' || lang END AS heading FROM (
        SELECT doc_id, lang, chunks, n_head, unnest(range(len(chunks))) AS i FROM (
          SELECT doc_id, lang, head || body AS chunks, len(head) AS n_head FROM (
            SELECT doc_id, lang,
              regexp_extract_all(lang || chr(10), '(?s).{1,300}(?:\n|\z)|.{1,300}[ \t]|.{1,300}') AS body,
              regexp_extract_all('## Part ' || lang || chr(10) || text || chr(12), '(?s).{1,300}(?:\n|\z)|.{1,300}[ \t]|.{1,300}') AS head
            FROM documents)))
    )
    SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS id, text, 'T' || doc_id AS title,
           coalesce(heading, 'Part ' || regexp_extract(trim(text, E'\n'), '(.*)', 1)) AS heading,
           CASE WHEN heading IS NULL THEN 2 ELSE 1 END AS page_num
    FROM c
    """
)
def document_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Titled documents with a heading and a page break, chunked and numbered in the order of the file."""
    path = scratch_path(spark, "titled")
    whole = F.concat(F.lit("## Part "), "lang", F.lit("\n"), "text", F.lit("\f"), "lang", F.lit("\n"))
    rows = table(spark, d, "documents").orderBy("doc_id").select(
        F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"), F.concat(F.lit("f"), (-F.col("doc_id")).cast("string")).alias("filename"), whole.alias("text")
    )
    sinks.write_json_lines(rows, path)
    documents = files.read_json_lines(spark, path, "title STRING, filename STRING, text STRING", source=True)
    return recipes.document_chunks(documents, 300).select("id", "text", "title", "heading", "page_num")


@query(
    r"""
    SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS id, '<' || conv_id || '.' || turn || '@box.example>' AS message_id,
           role AS subject, regexp_replace(regexp_replace(text, '(^|\n)From ', '\1>From ', 'g'), '\n+$', '') AS body, CASE WHEN role = 'user' THEN 'True' ELSE 'False' END AS inbox
    FROM conversations
    """
)
def mailbox_file(spark: SparkSession, d: str) -> DataFrame:
    """Mailbox files of conversation turns, split at their messages and numbered in their order."""
    path = scratch_path(spark, "box")
    message = F.concat(
        F.lit("From x@box.example Mon Jan 01 00:00:00 2024\nMessage-ID: <"), F.concat_ws(".", "conv_id", "turn"),
        F.lit("@box.example>\nSubject: "), "role", F.lit("\nX-Gmail-Labels: "), F.when(F.col("role") == "user", "Inbox").otherwise("Sent"),
        F.lit('\nContent-Type: text/plain; charset="utf-8"\nContent-Transfer-Encoding: 8bit\n\n'),
        F.regexp_replace("text", "(?m)^From ", ">From "), F.lit("\n"),
    )
    table(spark, d, "conversations").orderBy("conv_id", "turn").select(message.alias("value")).write.text(path)
    rows = mail.read_mbox(spark, path)
    return rows.select("id", "message_id", "subject", F.regexp_replace("body", "\n+$", "").alias("body"), F.col("Inbox").alias("inbox"))


@query(
    """
    SELECT row_number() OVER (ORDER BY o_orderkey) AS line, o_orderkey,
           CASE WHEN o_orderkey % 10 = 1 THEN 'rejected' ELSE o_orderstatus END AS status
    FROM orders
    """
)
def csv_rejects(spark: SparkSession, d: str) -> DataFrame:
    """A CSV file with rows that lack a field or hold a word for a number; good rows and rejects keep their line."""
    path = scratch_path(spark, "broken")
    key = F.col("o_orderkey")
    broken = F.when(key % 20 == 1, F.concat(key.cast("string"), F.lit(',"a, ""b""'), F.lit('\n"'))).otherwise(F.concat(F.lit("key "), key.cast("string"), F.lit(",x,F")))
    row = F.when(key % 10 == 1, broken).otherwise(F.concat(key.cast("string"), F.lit(',"c, ""d""\n",'), "o_orderstatus"))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of a file
    head = F.when(first, "o_orderkey,note,o_orderstatus\n").otherwise("")
    table(spark, d, "orders").orderBy("o_orderkey").select(F.concat(head, row).alias("value")).write.text(path)
    good, bad = files.read_csv_checked(spark, path, "o_orderkey BIGINT, note STRING, o_orderstatus STRING")
    every = good.select(*lines.SOURCE, "o_orderkey", F.col("o_orderstatus").alias("status")).unionByName(
        bad.select(*lines.SOURCE, F.regexp_extract("text", "([0-9]+)", 1).cast("bigint").alias("o_orderkey"), F.lit("rejected").alias("status"))
    )
    return _line_of(every).select("line", "o_orderkey", "status")


def _line_of(rows: DataFrame) -> DataFrame:
    """Dense line numbers from 1 without the header that every file has."""
    heads = rows.select("file").distinct().withColumn("nth", F.row_number().over(Window.orderBy("file")))  # one row a file
    return lines.source_ids(rows, "place").join(heads, "file").withColumn("line", F.col("place") - F.col("nth") + 1)


@query(
    """
    SELECT event_id, user_id, NULL AS reason FROM events WHERE event_id % 50 <> 3
    UNION ALL
    SELECT event_id, NULL, CASE WHEN event_id % 100 = 3 THEN 'no id' ELSE 'does not parse' END
    FROM events WHERE event_id % 50 = 3
    """
)
def ingest_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Events landed in two overlapping halves with null ids and broken lines: rows in the table, and what was rejected."""
    path = scratch_path(spark, "halves")
    e = F.col("event_id")
    good = F.to_json(F.struct("event_id", "user_id"))
    no_id = F.concat(F.lit('{"user_id": '), e.cast("string"), F.lit("}"))
    cut = F.concat(F.lit('{"user_id": '), e.cast("string"), F.lit(', "event_id"'))
    line = F.when(e % 50 != 3, good).when(e % 100 == 3, no_id).otherwise(cut).alias("value")
    events = table(spark, d, "events")
    for part in (e % 3 != 0, (e % 3 == 0) | (e % 50 != 3)):
        events.filter(part).select(line).write.mode("append").text(f"{path}/landing")
        streaming.ingest(
            spark, f"{path}/landing", "event_id BIGINT, user_id BIGINT", f"{path}/table", "event_id", f"{path}/checkpoint", fmt="json"
        ).awaitTermination()
    rejects = streaming.read_rejects(spark, f"{path}/table-rejects")
    number = F.regexp_extract("row", '"user_id": ?([0-9]+)', 1).cast("bigint")
    rows = keyed.read_published(spark, f"{path}/table").select("event_id", "user_id", F.lit(None).cast("string").alias("reason"))
    return rows.unionByName(rejects.select(number.alias("event_id"), F.lit(None).cast("bigint").alias("user_id"), "reason"))


@query(
    f"""WITH {_CORPUS_SQL}, q AS (SELECT id AS qid, v FROM c)
    {_ROUNDED_SQL} FROM ({_top_sql(k=5)})"""
)
def knn_cells(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest of every vector, from a clustered layout: only cells that can hold one are read."""
    corpus = _corpus(spark, d)
    layout = cells.build_layout(corpus, n_cells=16)
    return _rounded(cells.cell_search(corpus.select(F.col("id").alias("qid"), "embedding"), layout, 5)[0])


@query(
    f"""WITH {_CORPUS_SQL}, {_MEANS_SQL}
    {_ROUNDED_SQL} FROM ({_top_sql(score="list_distance(q.v, c.v)", order="ASC")})"""
)
def knn_cells_euclid(spark: SparkSession, d: str) -> DataFrame:
    corpus = _corpus(spark, d)
    return _rounded(cells.cell_search(_label_queries(corpus), cells.build_layout(corpus, n_cells=16), 10, "euclidean")[0])


@query(
    """
    SELECT conv_id::VARCHAR || '-' || turn AS call_id, i::INTEGER AS pos, lines[i + 1] AS utterance, role AS speaker_name,
           'call ' || conv_id AS call_title, i / len(lines) AS relative_start, (i + 1) / len(lines) AS relative_end
    FROM (SELECT *, unnest(range(len(lines))) AS i FROM (SELECT *, string_split(text, chr(10)) AS lines FROM conversations))
    """
)
def calls_timed(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts of one utterance a line, ten seconds each: positions as shares of the call's end."""
    turns = table(spark, d, "conversations")
    call_id = F.concat_ws("-", "conv_id", "turn")
    timed = lambda s, i: F.struct((i * 10).cast("bigint").alias("start"), (i * 10 + 10).cast("bigint").alias("end"), s.alias("text"))
    said = F.transform(
        F.split("text", "\n"),
        lambda s, i: F.struct(F.col("role").alias("speakerId"), F.lit("t").alias("topic"), F.array(timed(s, i)).alias("sentences")),
    )
    party = F.struct(
        F.col("role").alias("speakerId"), F.col("role").alias("name"), F.col("role").alias("emailAddress"), F.lit("us").alias("affiliation")
    )
    meta = F.struct(
        call_id.alias("id"), F.concat(F.lit("call "), F.col("conv_id").cast("string")).alias("title"),
        F.lit("2024-01-01").alias("started"), F.lit("https://call.example").alias("url"),
    )
    met = turns.select(meta.alias("metaData"), F.array(party).alias("parties"), F.col("conv_id").alias("seq"))
    return recipes.enriched_calls(turns.select(call_id.alias("callId"), said.alias("transcript")), met).select(
        "call_id", "pos", "utterance", "speaker_name", "call_title", "relative_start", "relative_end"
    )


@query(
    r"""
    WITH p AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="([^"]*)"', 1) AS links FROM pages)
    SELECT page_id, unnest(range(len(links)))::INTEGER AS pos, unnest(links) AS href FROM p
    """
)
def strong_links(spark: SparkSession, d: str) -> DataFrame:
    """Links inside ``strong`` elements, one of which stands in another; links beside them do not count."""
    page = F.replace(F.col("html"), F.lit("<nav>"), F.lit("<strong><nav><strong>"))
    page = F.replace(page, F.lit("</nav>"), F.lit('</strong></nav></strong><a href="/beside">b</a>'))
    return table(spark, d, "pages").select("page_id", F.posexplode(html.strong_hrefs(page)).alias("pos", "href"))


@query(
    r"""
    SELECT page_id, (1 + len(regexp_extract_all(html, '<li>')))::INTEGER AS n_items,
           'menu<nav>' || regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) || '</nav>&oacute; end' AS outer_html,
           regexp_extract(html, '(?s)<li>(.*?)</li>', 1) AS inner_html
    FROM pages WHERE contains(html, '<nav>')
    """
)
def nested_lists(spark: SparkSession, d: str) -> DataFrame:
    """List items that stand in a list item: each goes to its own closing tag."""
    page = F.replace(F.col("html"), F.lit("<nav>"), F.lit("<ul><LI class=x>menu<nav>"))
    page = F.replace(page, F.lit("</nav>"), F.lit("</nav>&oacute; end</li></ul>"))
    rows = table(spark, d, "pages").filter(F.contains("html", F.lit("<nav>"))).select("page_id", html.blocks(page, "li").alias("items"))
    return rows.select(
        "page_id", F.size("items").alias("n_items"), F.get("items", F.lit(0)).alias("outer_html"), F.get("items", F.lit(1)).alias("inner_html")
    )


@query(
    """
    SELECT o_orderkey, o_orderpriority AS status, 'P' AS kind FROM orders
    UNION ALL SELECT o_orderkey, o_custkey::VARCHAR, 'C' FROM orders
    """
)
def child_wins(spark: SparkSession, d: str) -> DataFrame:
    """Records exploded out of a parent that has a column of the same name as a field of theirs."""
    from weftline.operators.reshape import explode_records

    child = lambda col, kind: F.struct(col.alias("status"), F.lit(kind).alias("kind"))
    records = F.array(child(F.col("o_orderpriority"), "P"), child(F.col("o_custkey").cast("string"), "C"))
    parent = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), records.alias("records"))
    return explode_records(parent, "records")


@query("SELECT o_orderkey, o_orderstatus AS status, o_custkey AS customer FROM orders")
def json_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Files that each hold one JSON array: the orders of one range of keys."""
    path = scratch_path(spark, "arrays")
    record = F.struct("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"))
    grouped = table(spark, d, "orders").groupBy(F.floor(F.col("o_orderkey") / 8000)).agg(F.to_json(F.collect_list(record)).alias("value"))
    grouped.select("value").write.option("maxRecordsPerFile", 1).text(path)  # a key range holds 8,000 orders at most
    return files.read_json_array(spark, path, "o_orderkey BIGINT, status STRING, customer BIGINT")


@query(
    """
    SELECT 'user=' || lang AS user, 'folder=' || source AS folder, lang || '@mail.example' AS sender, source || chr(10) AS text, count(*) AS n
    FROM documents GROUP BY ALL
    """
)
def mail_files(spark: SparkSession, d: str) -> DataFrame:
    """An unpacked mail archive with a file for each message, read by user and folder."""
    path = scratch_path(spark, "archive")  # its folder `mail` is the root of the archive
    message = F.concat(F.lit("From: "), "lang", F.lit("@mail.example\nDate: Tue, 1 May 2001 08:30:59 -0700\n\n"), "source")
    rows = table(spark, d, "documents").select(F.col("lang").alias("user"), F.col("source").alias("folder"), message.alias("value"))
    sinks.write_text_per_row(rows, f"{path}/mail", "value", ["user", "folder"])
    found = mail.read_mail_files(spark, path).select(
        F.col("_user").alias("user"), F.col("_folder").alias("folder"), F.col("From").alias("sender"), F.col("_text").alias("text")
    )
    return found.groupBy("user", "folder", "sender", "text").agg(F.count(F.lit(1)).alias("n"))
