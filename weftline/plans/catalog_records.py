"""Queries over records: dedupe, cleaning, reshaping, lookups, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import dates, html, text
from weftline.operators import census, clean, dedupe, enrich, ids, reshape
from weftline.plans.catalog import query, table
from weftline.sources.files import date_slice as slice_of_day
from weftline.sources.files import fetch_by_ids as rows_with_ids
from weftline.sources.files import keyset_page as page_after
from weftline.sources.files import take_first as first_rows


@query(
    """
    SELECT text, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang,
           arg_min(source, doc_id) AS source, arg_min(n_chars, doc_id) AS n_chars,
           count(*) AS copies
    FROM documents GROUP BY text
    """
)
def exact_dedupe(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return dedupe.exact_dedupe(docs, "text", ["doc_id"], ["doc_id", "lang", "source", "n_chars"])


@query(
    """
    SELECT text, lang, min(doc_id) AS doc_id, count(*) AS copies
    FROM documents GROUP BY ALL ORDER BY copies DESC, doc_id
    """
)
def group_by_all_copies(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(
        "SELECT text, lang, min(doc_id) AS doc_id, count(*) AS copies "
        "FROM {docs} GROUP BY ALL ORDER BY copies DESC, doc_id",
        docs=table(spark, d, "documents"),
    )


@query(
    """
    SELECT min(event_id) AS event_id, user_id, event_type,
           strftime(arg_min(CASE WHEN ts < TIMESTAMP '2024-01-05' OR ts > TIMESTAMP '2024-01-25'
                    THEN TIMESTAMP '2024-01-05 01:00:00' ELSE ts END, (ts, event_id)),
                    '%Y-%m-%d %H:%M:%S') AS first_at,
           count(*) AS copies
    FROM events GROUP BY user_id, event_type ORDER BY copies DESC, event_id
    """
)
def earliest_copies(spark: SparkSession, d: str) -> DataFrame:
    """Dedupe by a pair of columns with the earliest instant, clamped, most copied first."""
    events = table(spark, d, "events")
    low, high, default = (
        F.lit(t).cast("timestamp_ntz")
        for t in ("2024-01-05 00:00:00", "2024-01-25 00:00:00", "2024-01-05 01:00:00")
    )
    first = F.min_by(clean.clamp(F.col("ts"), low, high, default), F.struct("ts", "event_id"))
    counts = events.groupBy("user_id", "event_type").agg(
        F.min("event_id").alias("event_id"),
        F.date_format(first, "yyyy-MM-dd HH:mm:ss").alias("first_at"),
        F.count(F.lit(1)).alias("copies"),
    )
    return dedupe.by_copies(counts, "event_id")


@query(
    """
    SELECT event_id, strftime(CASE WHEN ts < TIMESTAMP '2024-01-05' OR ts > TIMESTAMP '2024-01-25'
        THEN TIMESTAMP '2024-01-05 01:00:00' ELSE ts END, '%Y-%m-%d %H:%M:%S') AS clamped
    FROM events
    """
)
def timestamp_clamp(spark: SparkSession, d: str) -> DataFrame:
    low, high, default = (
        F.lit(t).cast("timestamp_ntz")
        for t in ("2024-01-05 00:00:00", "2024-01-25 00:00:00", "2024-01-05 01:00:00")
    )
    clamped = clean.clamp(F.col("ts"), low, high, default)
    return table(spark, d, "events").select(
        "event_id", F.date_format(clamped, "yyyy-MM-dd HH:mm:ss").alias("clamped")
    )


@query(
    r"""
    WITH f AS (
      SELECT page_id, nullif(trim(regexp_extract(html, '<b>([^<]*)</b>', 1)), '') AS bold,
             nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '') AS title
      FROM pages)
    SELECT page_id, coalesce(bold, title) AS text, coalesce(bold, '') AS bold
    FROM f WHERE coalesce(bold, title) IS NOT NULL
    """
)
def text_fallback(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select(
        "page_id",
        F.regexp_extract("html", "<b>([^<]*)</b>", 1).alias("bold"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
    )
    kept = clean.text_fallback(pages, ["bold", "title"], "text")
    blank = kept.withColumn("bold", text.blank_to_null(F.col("bold")))
    return clean.fill_empty(blank, ["bold"]).select("page_id", "text", "bold")


@query(
    """
    SELECT (row_number() OVER (ORDER BY conv_id, turn) - 1)::BIGINT AS id, conv_id, turn, role
    FROM conversations
    """
)
def row_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return ids.sequential_id(rows, ["conv_id", "turn"]).select("id", "conv_id", "turn", "role")


@query(
    """
    SELECT event_id, user_id, event_type, value FROM events
    WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-11'
    """
)
def date_slice(spark: SparkSession, d: str) -> DataFrame:
    day = slice_of_day(table(spark, d, "events"), "ts", "2024-01-11")
    return day.select("event_id", "user_id", "event_type", "value")


_LABELS = {
    "view": "Opened, Category Updates",
    "click": "Important,Inbox",
    "signup": "Inbox,Category Personal,Category Unknown",
    "purchase": "Archived , Category Purchases",
    "error": "Spam,IMAP_$Forwarded,Other",
}


@query(
    """
    SELECT event_id,
      CASE WHEN event_type IN ('click', 'signup') THEN 'True' ELSE 'False' END AS "Inbox",
      CASE WHEN event_type = 'click' THEN 'True' ELSE 'False' END AS "Important",
      CASE WHEN event_type = 'view' THEN 'True' ELSE 'False' END AS "Opened",
      'False' AS "Unread",
      CASE WHEN event_type = 'purchase' THEN 'True' ELSE 'False' END AS "Archived",
      'False' AS "Trash",
      CASE WHEN event_type = 'error' THEN 'True' ELSE 'False' END AS "Spam",
      CASE WHEN event_type = 'view' THEN 'True' ELSE 'False' END AS "Category_Updates",
      CASE WHEN event_type = 'signup' THEN 'True' ELSE 'False' END AS "Category_Personal",
      'False' AS "Category_Promotions",
      'False' AS "Category_Forums",
      CASE WHEN event_type = 'purchase' THEN 'True' ELSE 'False' END AS "Category_Purchases",
      CASE WHEN event_type = 'error' THEN 'True' ELSE 'False' END AS "IMAP_Forwarded"
    FROM events
    """
)
def label_flags(spark: SparkSession, d: str) -> DataFrame:
    from weftline.sources.mail import MAILBOX_LABELS

    names = F.create_map(*[F.lit(x) for pair in _LABELS.items() for x in pair])
    labelled = table(spark, d, "events").select("event_id", names[F.col("event_type")].alias("labels"))
    return reshape.label_flags(labelled, "labels", MAILBOX_LABELS, as_text=True).drop("labels")


@query(
    """
    SELECT user_id,
      bool_or(event_type = 'view') AS view, bool_or(event_type = 'click') AS click,
      bool_or(event_type = 'signup') AS signup, bool_or(event_type = 'purchase') AS purchase,
      bool_or(event_type = 'error') AS error
    FROM events GROUP BY user_id
    """
)
def user_flags(spark: SparkSession, d: str) -> DataFrame:
    kinds = ("view", "click", "signup", "purchase", "error")
    return (
        table(spark, d, "events")
        .groupBy("user_id")
        .agg(*[F.bool_or(F.col("event_type") == k).alias(k) for k in kinds])
    )


@query(
    """
    SELECT o_orderkey, 0 AS group_no, o_orderstatus AS name, o_totalprice AS amount FROM orders
    UNION ALL SELECT o_orderkey, 1, o_orderpriority, o_custkey::DOUBLE FROM orders
    UNION ALL SELECT o_orderkey, 2, strftime(o_orderdate, '%Y-%m-%d'), o_orderkey::DOUBLE FROM orders
    """
)
def wide_to_long(spark: SparkSession, d: str) -> DataFrame:
    wide = table(spark, d, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        F.col("o_custkey").cast("double").alias("cust"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.col("o_orderkey").cast("double").alias("key"),
    )
    groups = [["o_orderstatus", "o_totalprice"], ["o_orderpriority", "cust"], ["day", "key"]]
    return reshape.wide_to_long(wide, groups, ["name", "amount"], required="name")


@query(
    """
    WITH s AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents)
    SELECT doc_id, text AS utterance, 0::BIGINT AS "start",
           ((len(lines) - 1) * 100 + length(lines[-1]))::BIGINT AS "end"
    FROM s
    """
)
def group_text(spark: SparkSession, d: str) -> DataFrame:
    """Sentence arrays back to one text, with the first start and the last end."""
    sentences = F.transform(
        F.split("text", "\n"),
        lambda s, i: F.struct(
            (i * 100).cast("bigint").alias("start"),
            (i * 100 + F.length(s)).cast("bigint").alias("end"),
            s.alias("text"),
        ),
    )
    docs = table(spark, d, "documents").select("doc_id", sentences.alias("sentences"))
    said, start, end = reshape.spoken(F.col("sentences"))
    return docs.select("doc_id", said.alias("utterance"), start.alias("start"), end.alias("end"))


@query(
    """
    SELECT doc_id, i::INTEGER AS pos, lines[i + 1] AS line FROM (
      SELECT doc_id, lines, unnest(range(len(lines))) AS i
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
    """
)
def exploded_lines(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(
        "doc_id", F.transform(F.split("text", "\n"), lambda s: F.struct(s.alias("line"))).alias("lines")
    )
    return reshape.explode_records(docs, "lines", pos="pos")


@query(
    """
    SELECT event_id, (props->>'k')::BIGINT AS k, '{"k":' || (props->>'k') || '}' AS props_json FROM events
    """
)
def json_field(spark: SparkSession, d: str) -> DataFrame:
    parsed = table(spark, d, "events").select("event_id", F.from_json("props", "k BIGINT").alias("props"))
    flat = reshape.flatten_fields(parsed, {"event_id": "event_id", "k": "props.k"})
    return flat.withColumn("props_json", text.as_json("k"))


@query(
    """
    SELECT page_id, nullif(regexp_extract(url, '//([^./]+)', 1), '') AS slug FROM pages
    """
)
def host_slug(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.host_slug(F.col("url")).alias("slug"))


@query(
    """
    SELECT page_id, nullif(regexp_extract(url, '//([^/?#]+)', 1), '') AS host FROM pages
    """
)
def host_of_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.host_of(F.col("url")).alias("host"))


@query(
    r"""
    WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS u FROM pages)
    SELECT page_id, regexp_extract(rtrim(u, '/'), '([^/]*)$', 1) AS segment,
           regexp_replace(regexp_extract(u, '([^/]*)$', 1), '([^.])[.][^.]*$', '\1') AS stem,
           lower(list_aggregate(list_sort(string_split(regexp_extract(u, '//([^/]+)', 1), '.')), 'string_agg', '_')) AS host_parts
    FROM p
    """
)
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    url = F.regexp_replace("url", "[?#].*$", "")
    return table(spark, d, "pages").select(
        "page_id",
        text.last_segment(url).alias("segment"),
        text.file_stem(url).alias("stem"),
        F.lower(text.joined_sorted(F.split(text.host_of(url), r"\."))).alias("host_parts"),
    )


@query(
    """
    WITH a AS (
      SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_name ELSE c_name || '@' || c_mktsegment || '.example' END AS address
      FROM customer)
    SELECT c_custkey, coalesce(CASE WHEN contains(address, '@') THEN string_split(address, '@')[2] END, '') AS domain FROM a
    """
)
def mail_domain(spark: SparkSession, d: str) -> DataFrame:
    address = F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(
        F.concat("c_name", F.lit("@"), "c_mktsegment", F.lit(".example"))
    )
    return table(spark, d, "customer").select(
        "c_custkey", text.or_empty(text.part_after_at(address)).alias("domain")
    )


@query(
    """
    SELECT o_orderkey, r.c_name AS requester, s.c_name AS submitter, a.c_name AS assignee,
           n.n_name AS nation, g.r_name AS region
    FROM (SELECT o_orderkey, o_custkey AS requester_id, o_orderkey AS submitter_id,
                 CASE WHEN o_orderstatus = 'O' THEN o_custkey + 1 END AS assignee_id FROM orders) t
    LEFT JOIN customer r ON r.c_custkey = requester_id
    LEFT JOIN customer s ON s.c_custkey = submitter_id
    LEFT JOIN customer a ON a.c_custkey = assignee_id
    LEFT JOIN nation n ON n.n_nationkey = r.c_nationkey
    LEFT JOIN region g ON g.r_regionkey = n.n_regionkey
    """
)
def role_dims(spark: SparkSession, d: str) -> DataFrame:
    tickets = table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("requester_id"),
        F.col("o_orderkey").alias("submitter_id"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_custkey") + 1).alias("assignee_id"),
    )
    people = {
        "requester_id": {"c_name": "requester", "c_nationkey": "nation_key"},
        "submitter_id": {"c_name": "submitter"},
        "assignee_id": {"c_name": "assignee"},
    }
    rows = enrich.lookup(tickets, table(spark, d, "customer"), "c_custkey", people)
    nation = {"nation_key": {"n_name": "nation", "n_regionkey": "region_key"}}
    rows = enrich.lookup(rows, table(spark, d, "nation"), "n_nationkey", nation)
    rows = enrich.lookup(rows, table(spark, d, "region"), "r_regionkey", {"region_key": {"r_name": "region"}})
    return clean.whitelist(rows, ["o_orderkey", "requester", "submitter", "assignee", "nation", "region"])


@query(
    """
    SELECT l_orderkey, l_linenumber, o_orderstatus, o_orderpriority
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    """
)
def large_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A lookup whose dimension is a large table: hot keys are spread over tasks."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_orderpriority"
    )
    return enrich.lookup_large(lines, orders, "l_orderkey", "l_linenumber")


@query(
    """
    SELECT l_suppkey AS supplier, count(*) AS n FROM
      (SELECT CASE WHEN l_returnflag = 'R' THEN -l_suppkey ELSE l_suppkey END AS l_suppkey FROM lineitem)
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1
    """
)
def orphan_audit(spark: SparkSession, d: str) -> DataFrame:
    """Lines whose supplier key is unknown; returned lines carry a key that no supplier has."""
    lines = table(spark, d, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", -F.col("l_suppkey")).otherwise(F.col("l_suppkey")).alias("supplier")
    )
    return enrich.orphans(lines, table(spark, d, "supplier"), "supplier", "s_suppkey")


@query(
    """
    SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id,
           arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
    FROM events GROUP BY user_id
    """
)
def latest_by_key(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return dedupe.latest_by_key(events, "user_id", ["ts", "event_id"]).drop("ts")


@query(
    r"""
    SELECT token, count(*) AS n FROM (
      SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS token FROM documents)
    WHERE token <> '' GROUP BY token ORDER BY n DESC, token LIMIT 21
    """
)
def top_tokens(spark: SparkSession, d: str) -> DataFrame:
    from weftline.operators.embed import words

    tokens = table(spark, d, "documents").select(F.explode(words(F.col("text"))).alias("token"))
    return census.top_values(tokens, "token", 21)


@query(
    """
    SELECT key, count(*) AS n FROM (
      SELECT unnest(json_keys(props)) AS key FROM events
      UNION ALL SELECT event_type FROM events)
    GROUP BY key ORDER BY n DESC, key LIMIT 21
    """
)
def common_map_keys(spark: SparkSession, d: str) -> DataFrame:
    props = F.from_json("props", "MAP<STRING, BIGINT>")
    marked = F.map_concat(props, F.create_map("event_type", F.lit(1).cast("bigint")))
    return census.common_keys(table(spark, d, "events").select(marked.alias("props")), "props")


@query("SELECT * FROM documents ORDER BY md5('3-' || doc_id), doc_id LIMIT 100")
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    """A sample of fixed size, by the order of a hash of the id; the size is the operator."""
    return census.fixed_sample(table(spark, d, "documents"), "doc_id", 100, seed=3)


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type")
def topic_sets(spark: SparkSession, d: str) -> DataFrame:
    return census.distinct_per_group(table(spark, d, "events"), "user_id", "event_type")


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def facets(spark: SparkSession, d: str) -> DataFrame:
    return census.facets(table(spark, d, "documents"), "lang", "source")


@query("SELECT quality, toxic, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY quality, toxic")
def label_facets(spark: SparkSession, d: str) -> DataFrame:
    rows = enrich.align_vectors(table(spark, d, "labels"), table(spark, d, "documents").select("doc_id"), "doc_id")
    return census.facets(rows, "quality", "toxic")


@query("SELECT count(*) AS n FROM lineitem")
def row_counts(spark: SparkSession, d: str) -> DataFrame:
    return census.row_count(table(spark, d, "lineitem"))


@query(
    """
    WITH u AS (SELECT conv_id, turn, turn * 100 AS s, turn * 100 + length(text) % 100 AS e FROM conversations),
    m AS (SELECT *, last_value(e) OVER (PARTITION BY conv_id ORDER BY turn
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS whole FROM u)
    SELECT conv_id, turn, round(s::DOUBLE / nullif(whole, 0), 6) AS relative_start,
           round(e::DOUBLE / nullif(whole, 0), 6) AS relative_end FROM m
    """
)
def relative_position(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        (F.col("turn") * 100).alias("s"),
        (F.col("turn") * 100 + F.length("text") % 100).alias("e"),
    )
    placed = enrich.relative_position(rows, "conv_id", "turn", "s", "e")
    return placed.select(
        "conv_id",
        "turn",
        F.round("relative_start", 6).alias("relative_start"),
        F.round("relative_end", 6).alias("relative_end"),
    )


@query(
    """
    SELECT d.doc_id::VARCHAR AS id, quality::DOUBLE AS quality,
           coalesce(nullif(CASE WHEN toxic = 1 THEN lang ELSE '' END, ''), 'N/A') AS flagged_lang,
           CASE WHEN toxic = 1 THEN 'True' WHEN toxic = 0 THEN 'False' END AS toxic,
           CASE WHEN contains(text, '|') THEN list_aggregate(string_split(source, 'c'), 'string_agg', ', ') ELSE 'N/A' END AS parts
    FROM documents d LEFT JOIN labels USING (doc_id)
    """
)
def typed_record(spark: SparkSession, d: str) -> DataFrame:
    """Casts, booleans as text, and N/A for empty text and lists."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    shaped = rows.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("quality").cast("double").alias("quality"),
        F.when(F.col("toxic") == 1, F.col("lang")).otherwise("").alias("flagged_lang"),
        text.bool_text(F.col("toxic") == 1).alias("toxic"),
        F.when(F.contains("text", F.lit("|")), F.split("source", "c"))
        .otherwise(F.array().cast("array<string>"))
        .alias("parts"),
    )
    return clean.fill_na(shaped, ["flagged_lang", "parts", "quality"])


@query(
    """
    SELECT doc_id AS id, source AS origin, lang, NULL::VARCHAR AS title FROM documents
    """
)
def whitelisted(spark: SparkSession, d: str) -> DataFrame:
    docs = clean.renamed(table(spark, d, "documents"), {"doc_id": "id", "source": "origin"}, drop=["n_chars"])
    return clean.whitelist(docs, ["id", "origin", "lang", "title"])


@query("SELECT p_name, p_brand, p_type FROM part")
def text_only(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    return part.select(*reshape.text_fields(part))


@query("SELECT page_id, url FROM pages WHERE contains(url, 'example') AND contains(url, '/en/')")
def two_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").filter(text.contains_all(F.col("url"), "example", "/en/")).select("page_id", "url")


@query(
    """
    SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND lang <> ''
    """
)
def present_only(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return clean.with_value(rows, "quality", "lang").select("doc_id", "quality")


@query("SELECT doc_id, substring(text, 1, 100) AS shown FROM documents")
def display_head(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.head(F.col("text"), 100).alias("shown"))


@query(
    r"""
    SELECT conv_id, turn,
      CASE WHEN role = 'user' THEN role ELSE '[deleted]' END AS author,
      coalesce(nullif(CASE WHEN turn = 0 THEN '' ELSE 'thread-' || conv_id END, ''), 'root-' || conv_id) AS thread_id,
      strftime(TIMESTAMP '1970-01-01' + to_seconds(conv_id * 86400 + turn), '%Y-%m-%d %H:%M:%S') AS created_at,
      role || ' ' || chr(10) || ' ' || text AS title_text
    FROM conversations
    """
)
def message_fields(spark: SparkSession, d: str) -> DataFrame:
    thread = F.when(F.col("turn") == 0, "").otherwise(F.concat(F.lit("thread-"), "conv_id"))
    root = F.concat(F.lit("root-"), F.col("conv_id").cast("string"))
    return table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        text.deleted_author(F.when(F.col("role") == "user", F.col("role"))).alias("author"),
        text.thread_id(thread, F.lit(None).cast("string"), root, root).alias("thread_id"),
        F.date_format(
            dates.from_epoch(F.col("conv_id") * 86400 + F.col("turn")), "yyyy-MM-dd HH:mm:ss"
        ).alias("created_at"),
        text.title_and_subtitle(F.col("role"), F.col("text")).alias("title_text"),
    )


@query("SELECT * EXCLUDE (embedding) FROM embeddings SEMI JOIN labels ON vec_id = doc_id")
def fetch_by_ids(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "labels").select(F.col("doc_id").alias("vec_id"))
    return rows_with_ids(table(spark, d, "embeddings").select("vec_id", "label"), wanted, "vec_id")


@query("SELECT vec_id, label FROM embeddings WHERE vec_id > 100 ORDER BY vec_id LIMIT 50")
def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    """One page of a paged scan; the limit is the operator."""
    return page_after(table(spark, d, "embeddings").select("vec_id", "label"), "vec_id", 50, cursor=100)


@query("SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 100")
def take_first(spark: SparkSession, d: str) -> DataFrame:
    """The first rows of a split; the limit is the operator."""
    return first_rows(table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id", 100)


@query(
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
    """
)
def union_batches(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    suppliers = table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_name AS name")
    return dedupe.union_all(customers, suppliers)


@query("SELECT o_custkey AS id, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def repeated_ids(spark: SparkSession, d: str) -> DataFrame:
    return ids.bad_ids(table(spark, d, "orders").select(F.col("o_custkey").alias("id")), "id")


@query(
    r"""
    SELECT DISTINCT link FROM (
      SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM pages)
    WHERE link NOT IN (SELECT '/' || lang FROM documents)
    """
)
def unvisited_links(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "pages").select(F.explode(html.hrefs(F.col("html"))).alias("link"))
    visited = table(spark, d, "documents").select(F.concat(F.lit("/"), "lang").alias("link"))
    return dedupe.unvisited(dedupe.distinct_rows(links, "link"), visited.distinct(), "link")
