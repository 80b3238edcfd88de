"""Queries over the readers and writers. Their input files are written by Spark from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import census
from weftline.plans import recipes
from weftline.plans.catalog import query, table
from weftline.sinks import files as sinks
from weftline.sinks import publish as keyed
from weftline.sources import commits, files, mail, pages
from weftline.storage import materialize, scratch_path
from weftline.streaming import ingest as streaming


def _commit_lines(spark: SparkSession, d: str) -> DataFrame:
    """One log line per order; orders of status P lack a field."""
    when = F.date_format("o_orderdate", "MMM d HH:mm:ss yyyy")
    return table(spark, d, "orders").select(
        F.col("o_orderstatus").alias("repo"),
        F.concat(
            F.lit("c"),
            "o_orderkey",
            F.lit(";"),
            F.concat(F.lit("author"), F.col("o_custkey").cast("string")),
            F.when(F.col("o_orderstatus") == "P", "").otherwise(";a@b.example"),
            F.lit(";Mon "),
            when,
            F.lit(" -0500;fix; "),
            "o_orderpriority",
        ).alias("value"),
    )


@query(
    """
    SELECT o_orderstatus AS repo, 'c' || o_orderkey AS hash, 'author' || o_custkey AS author,
           'a@b.example' AS email, strftime(o_orderdate, '%Y-%m-%d') AS date,
           'fix; ' || o_orderpriority AS message,
           strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS committed_at
    FROM orders WHERE o_orderstatus <> 'P'
    """
)
def commit_log(spark: SparkSession, d: str) -> DataFrame:
    good, _ = commits.parse_commits(_commit_lines(spark, d))
    return good.withColumn("committed_at", F.date_format("committed_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    """
    SELECT o_orderstatus AS repo, 'bad date' AS reason, count(*) AS n FROM orders
    WHERE o_orderstatus = 'P' GROUP BY ALL
    """
)
def commit_rejects(spark: SparkSession, d: str) -> DataFrame:
    _, rejects = commits.parse_commits(_commit_lines(spark, d))
    return census.facets(rejects, "repo", "reason")


@query(
    """
    SELECT (row_number() OVER (ORDER BY o_orderstatus, o_orderdate, 'c' || o_orderkey))::BIGINT AS id,
           o_orderstatus AS repo, 'c' || o_orderkey AS hash
    FROM orders WHERE o_orderstatus <> 'P'
    """
)
def commit_collection(spark: SparkSession, d: str) -> DataFrame:
    good, _ = commits.parse_commits(_commit_lines(spark, d))
    return recipes.commit_collection(good).select("id", "repo", "hash")


def _archive_mail(spark: SparkSession, d: str) -> DataFrame:
    """One archived message per document, as raw bytes below a user and a folder."""
    day = F.date_add(F.lit("2001-05-01").cast("date"), (F.col("doc_id") % 300).cast("int"))
    head = F.concat(
        F.lit("Message-ID: <"),
        "doc_id",
        F.lit("@mail.example>\nDate: "),
        F.date_format(day, "'Tue, 'd MMM yyyy"),
        F.lit(" 08:30:59 -0700 (PDT)\nFrom: "),
        "source",
        F.lit("@"),
        "lang",
        F.lit(".example\nSubject: about "),
        "source",
        F.lit("\nX-Origin: "),
        "lang",
        F.lit("\nX-Origin: second\n\n"),
    )
    return table(spark, d, "documents").select(
        F.col("lang").alias("_user"),
        F.col("source").alias("_folder"),
        F.concat(F.lit("mail/"), "lang", F.lit("/"), "source", F.lit("/"), "doc_id").alias("_filename"),
        F.encode(F.concat(head, "text"), "ISO-8859-1").alias("content"),
    )


@query(
    """
    WITH m AS (SELECT text, lang, source, doc_id, 'mail/' || lang || '/' || source || '/' || doc_id AS f,
      DATE '2001-05-01' + (doc_id % 300)::INTEGER + INTERVAL '15 hours 30 minutes 59 seconds' AS ts FROM documents)
    SELECT text, arg_min(source || '@' || lang || '.example', (ts, f)) AS sender,
           arg_min(lang || '.example', (ts, f)) AS domain, arg_min(lang, (ts, f)) AS origin,
           arg_min('about ' || source, (ts, f)) AS subject,
           strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS sent_at, count(*) AS copies
    FROM m GROUP BY text
    """
)
def mail_archive(spark: SparkSession, d: str) -> DataFrame:
    """Parse an archive, keep the earliest copy of every text."""
    rows = mail.archive_rows(mail.parse_archived(_archive_mail(spark, d), "content"))
    return recipes.mail_collection(rows).select(
        "text",
        F.col("From").alias("sender"),
        F.col("from-domain").alias("domain"),
        F.col("X-Origin").alias("origin"),
        F.col("Subject").alias("subject"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("sent_at"),
        "copies",
    )


@query(
    """
    SELECT unnest(['Date', 'From', 'Message-ID', 'Subject', 'X-Origin']) AS key, n
    FROM (SELECT count(*) AS n FROM documents)
    """
)
def header_census(spark: SparkSession, d: str) -> DataFrame:
    return census.common_keys(mail.parse_headers(_archive_mail(spark, d), "content"), "headers", 21)


def _mailbox_mail(spark: SparkSession, d: str) -> DataFrame:
    """Mailbox messages: conversation turns as plain text beside HTML, or as HTML alone."""
    plain_part = F.concat(
        F.lit('--b\nContent-Type: text/plain; charset="utf-8"\nContent-Transfer-Encoding: 8bit\n\n'), "text", F.lit("\n")
    )
    html_part = F.concat(
        F.lit('--b\nContent-Type: text/html; charset="utf-8"\nContent-Transfer-Encoding: 8bit\n\n<p>'),
        F.col("role"),
        F.lit(" &amp; turn <b>"),
        F.col("turn").cast("string"),
        F.lit("</b></p>\n"),
    )
    head = F.concat(
        F.lit("Message-ID: <"),
        F.concat_ws(".", "conv_id", "turn"),
        F.lit("@box.example>\nIn-Reply-To: <"),
        F.col("conv_id").cast("string"),
        F.lit("@box.example>\nDate: 3 Jan 2024 10:20:30 +0100\nFrom: =?utf-8?q?J=C3=B6rg?= <j@box.example>\nX-Gmail-Labels: "),
        F.when(F.col("role") == "user", "Inbox,Opened").otherwise("Category Updates"),
        F.lit('\nMIME-Version: 1.0\nContent-Type: multipart/alternative; boundary="b"\n\n'),
    )
    body = F.when(F.col("turn") % 2 == 0, F.concat(html_part, plain_part)).otherwise(html_part)
    return table(spark, d, "conversations").select(
        "conv_id", "turn", F.encode(F.concat(head, body, F.lit("--b--\n")), "UTF-8").alias("content")
    )


@query(
    """
    SELECT '<' || conv_id || '.' || turn || '@box.example>' AS message_id,
           '<' || conv_id || '@box.example>' AS thread_id, '2024-01-03 09:20:30' AS date,
           'Jörg  <j@box.example>' AS "from",
           CASE WHEN turn % 2 = 0 THEN text ELSE role || ' & turn ' || turn END AS body,
           CASE WHEN role = 'user' THEN 'True' ELSE 'False' END AS inbox,
           CASE WHEN role = 'user' THEN 'False' ELSE 'True' END AS updates
    FROM conversations
    """
)
def mailbox(spark: SparkSession, d: str) -> DataFrame:
    rows = mail.mailbox_rows(mail.parse_messages(_mailbox_mail(spark, d), "content"))
    return rows.select(
        "message_id",
        "thread_id",
        F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"),
        "from",
        "body",
        F.col("Inbox").alias("inbox"),
        F.col("Category_Updates").alias("updates"),
    )


@query(
    """
    SELECT 'https://t.example/' || o_orderkey AS url, o_orderkey AS id,
           strftime(o_orderdate, '%Y-%m-%d') AS created_at, o_orderpriority AS type, o_orderstatus AS subject,
           NULL::VARCHAR AS description, lower(r.c_name) AS requester_email,
           lower(s.c_name) AS submitter_email, NULL::VARCHAR AS assignee_email
    FROM orders LEFT JOIN customer r ON r.c_custkey = o_custkey
    LEFT JOIN customer s ON s.c_custkey = o_orderkey
    """
)
def ticket_pages(spark: SparkSession, d: str) -> DataFrame:
    """Tickets and users landed as API pages, read back and joined."""
    ticket = F.struct(
        F.concat(F.lit("https://t.example/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
        F.col("o_orderpriority").alias("type"),
        F.col("o_orderstatus").alias("subject"),
        F.col("o_custkey").alias("requester_id"),
        F.col("o_orderkey").alias("submitter_id"),
    )
    user = F.struct(F.col("c_custkey").alias("id"), F.lower("c_name").alias("email"))
    landed = scratch_path(spark, "api-pages")
    sinks.write_json_lines(
        table(spark, d, "orders").select(F.struct(F.array(ticket).alias("tickets")).alias("content")),
        f"{landed}/tickets",
    )
    sinks.write_json_lines(
        table(spark, d, "customer").select(F.struct(F.array(user).alias("users")).alias("content")),
        f"{landed}/users",
    )
    tickets = pages.read_pages(spark, f"{landed}/tickets", pages.TICKET_PAGE, "content.tickets", multi_line=False)
    users = pages.read_pages(spark, f"{landed}/users", pages.USER_PAGE, "content.users", multi_line=False)
    nobody = spark.createDataFrame([], "id BIGINT, name STRING")
    return recipes.ticket_table(tickets, users, nobody)


@query(
    """
    SELECT cursor FROM (SELECT DISTINCT c_nationkey + 1 AS cursor FROM customer)
    WHERE cursor NOT IN (SELECT n_nationkey FROM nation)
    """
)
def page_chain(spark: SparkSession, d: str) -> DataFrame:
    """Cursors that some page hands out but no page answers."""
    handed = table(spark, d, "customer").selectExpr("CAST(NULL AS INT) AS asked", "c_nationkey + 1 AS cursor")
    answered = table(spark, d, "nation").selectExpr("n_nationkey AS asked", "CAST(NULL AS INT) AS cursor")
    return pages.missing_pages(handed.unionByName(answered), "asked", "cursor")


@query(
    """
    SELECT doc_id::VARCHAR AS id, CASE WHEN toxic = 1 THEN lang ELSE source END AS text,
           strftime(DATE '2024-01-01' + (doc_id % 28)::INTEGER, '%Y-%m-%d') AS publication_date,
           lang || ', ' AS agency_names, coalesce(source, '') AS topics
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def register(spark: SparkSession, d: str) -> DataFrame:
    """Register records from documents: blank abstracts fall back to the title."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    agency = "STRUCT<name: STRING>"
    documents = rows.select(
        F.lit(None).cast("string").alias("document_number"),
        F.col("doc_id").cast("string").alias("id"),
        F.when(F.col("toxic") == 1, F.concat(F.lit(" \t"), "lang", F.lit("\n"))).otherwise(" \n ").alias("abstract"),
        F.concat(F.lit(" "), "source", F.lit(" ")).alias("title"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int")), "yyyy-MM-dd").alias("publication_date"),
        F.lit("Notice").alias("type"),
        F.array(F.struct(F.col("lang").alias("name")), F.lit(None).cast(agency)).alias("agencies"),
        F.array("source").alias("topics"),
        F.lit(None).cast("string").alias("html_url"),
    )
    return recipes.register_records(documents).select(
        "id", "text", F.date_format("publication_date", "yyyy-MM-dd").alias("publication_date"), "agency_names", "topics"
    )


@query(
    """
    SELECT conv_id::VARCHAR || '-' || role AS call_id, text AS utterance, role AS speaker_name,
           role || '@call.example' AS speaker_email, 'call ' || role AS call_title,
           0.0::DOUBLE AS relative_start, 1.0::DOUBLE AS relative_end
    FROM conversations
    """
)
def calls(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts with one utterance per turn, with speaker and call looked up."""
    turns = table(spark, d, "conversations")
    call_id = F.concat_ws("-", "conv_id", "role")
    sentences = F.transform(
        F.split("text", "\n"),
        lambda s, i: F.struct((i * 0).cast("bigint").alias("start"), F.lit(10).cast("bigint").alias("end"), s.alias("text")),
    )
    transcripts = turns.select(
        call_id.alias("callId"),
        F.array(F.struct(F.col("role").alias("speakerId"), F.lit("t").alias("topic"), sentences.alias("sentences"))).alias("transcript"),
    )
    party = F.struct(
        F.col("role").alias("speakerId"),
        F.col("role").alias("name"),
        F.concat("role", F.lit("@call.example")).alias("emailAddress"),
        F.lit("us").alias("affiliation"),
    )
    met = turns.select("conv_id", "role").distinct().select(
        F.struct(
            call_id.alias("id"),
            F.concat(F.lit("call "), "role").alias("title"),
            F.lit("2024-01-01").alias("started"),
            F.lit("https://call.example").alias("url"),
        ).alias("metaData"),
        F.array(party).alias("parties"),
        F.col("conv_id").alias("seq"),
    )
    return recipes.enriched_calls(transcripts, met).select(
        "call_id", "utterance", "speaker_name", "speaker_email", "call_title", "relative_start", "relative_end"
    )


@query("SELECT doc_id::VARCHAR AS id, text, lang AS label FROM documents")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Texts with commas, quotes and line ends through a CSV file."""
    path = scratch_path(spark, "csv")
    rows = table(spark, d, "documents").select(F.col("lang").alias("label"), F.col("doc_id").alias("id"), "text")
    sinks.write_csv(rows, path, ["id", "text", "label"])
    return files.read_csv(spark, path, "id STRING, text STRING, label STRING")


@query(
    """
    SELECT conv_id, turn, text FROM conversations
    UNION ALL SELECT item_id, -1, text FROM benchmark
    """
)
def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines, overwritten and then appended to."""
    path = scratch_path(spark, "jsonl")
    sinks.write_json_lines(table(spark, d, "conversations").select("conv_id", "turn", "text"), path)
    more = table(spark, d, "benchmark").selectExpr("item_id AS conv_id", "-1L AS turn", "text")
    sinks.append_json_lines(more, path)
    return files.read_json_lines(spark, path, "conv_id BIGINT, turn BIGINT, text STRING")


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def zstd_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "zstd")
    sinks.write_parquet(
        table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"), path
    )
    return files.read_parquet(spark, path)


@query("SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang")
def per_class(spark: SparkSession, d: str) -> DataFrame:
    """One dataset per class, written and read back."""
    path = scratch_path(spark, "per-class")
    sinks.write_per_class(table(spark, d, "documents").select("doc_id", "n_chars", "lang"), path, "lang")
    return files.read_parquet(spark, path).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")
    )


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def stage_cache(spark: SparkSession, d: str) -> DataFrame:
    """A stage that is built once and then read."""
    path = scratch_path(spark, "stage")
    events = table(spark, d, "events")
    materialize(spark, path, lambda: events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))
    return materialize(spark, path, lambda: events.limit(0).selectExpr("user_id", "0L AS n"))


@query(
    """
    SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer
    UNION ALL SELECT s_suppkey + 100000000000, s_name, s_acctbal FROM supplier
    """
)
def upsert(spark: SparkSession, d: str) -> DataFrame:
    """Customers, then their new balances and new keys; the second batch is written twice."""
    path = scratch_path(spark, "keyed")
    held = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    changed = held.filter("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    added = table(spark, d, "supplier").selectExpr(
        "s_suppkey + 100000000000L AS c_custkey", "s_name AS c_name", "s_acctbal AS c_acctbal"
    )
    keyed.publish(held, path, "c_custkey")
    for _ in range(2):
        keyed.publish(changed.unionByName(added), path, "c_custkey", mode="upsert", batch=1)
    return keyed.read_published(spark, path, "c_custkey")


@query("SELECT p_partkey, p_name FROM part")
def keyed_append(spark: SparkSession, d: str) -> DataFrame:
    """The same rows appended twice, then the table folded: known ids are not added again."""
    path = scratch_path(spark, "append")
    rows = table(spark, d, "part").select("p_partkey", "p_name")
    keyed.publish(rows, path, "p_partkey")
    keyed.publish(rows.withColumn("p_name", F.lit("again")), path, "p_partkey")
    keyed.compact(spark, path, f"{path}-folded", "p_partkey")
    return keyed.read_published(spark, f"{path}-folded", "p_partkey")


@query("SELECT n_nationkey, n_name FROM nation")
def replace_table(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "replace")
    keyed.publish(table(spark, d, "region").selectExpr("r_regionkey AS n_nationkey", "r_name AS n_name"), path, "n_nationkey")
    keyed.publish(table(spark, d, "nation").select("n_nationkey", "n_name"), path, "n_nationkey", mode="replace")
    return keyed.read_published(spark, path, "n_nationkey")


@query("SELECT event_id, user_id, event_type, value FROM events")
def incremental_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Events streamed into a keyed table, by two runs of the daily job."""
    path = scratch_path(spark, "ingest")
    events = table(spark, d, "events")
    for _ in range(2):
        streaming.ingest(
            spark,
            d,
            events.schema,
            f"{path}/table",
            "event_id",
            f"{path}/checkpoint",
            transform=lambda df: df.select("event_id", "user_id", "event_type", "value"),
            pattern="events.parquet",
        ).awaitTermination()
    return keyed.read_published(spark, f"{path}/table", "event_id")
