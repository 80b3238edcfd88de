"""Whole jobs: from landed files or tables to the flat record a collection is built on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.dates import from_epoch, iso_date
from weftline.functions.html import block_with_id, blocks_with_class, hrefs, labelled_block, visible_text
from weftline.functions.text import (
    deleted_author,
    host_slug,
    joined_names,
    joined_texts,
    or_empty,
    part_after_at,
    strip,
    title_and_subtitle,
)
from weftline.functions.urls import resolve
from weftline.operators.chunk import chunk
from weftline.operators.clean import archive_clamp, fill_na, text_fallback, whitelist
from weftline.operators.dedupe import exact_dedupe, latest_by_key
from weftline.operators.enrich import lookup
from weftline.operators.graph import flatten_tree
from weftline.operators.ids import sequential_id
from weftline.operators.reshape import explode_records, spoken, wide_to_long
from weftline.sources.files import read_csv, read_json_lines
from weftline.sources.lines import SOURCE, source_ids

# The columns of the ticket export and of a proceedings record.
TICKET_COLUMNS = (
    "url",
    "id",
    "created_at",
    "type",
    "subject",
    "description",
    "requester_email",
    "submitter_email",
    "assignee_email",
)
PROCEEDINGS_COLUMNS = (
    "abstract",
    "affiliations",
    "authors",
    "id",
    "last_author",
    "last_author_affiliation",
    "link",
    "title",
    "year",
)


def register_records(documents: DataFrame) -> DataFrame:
    """Register documents with text: abstract, else title; lists of agencies and topics as text."""
    with_text = text_fallback(documents, ["abstract", "title"], "text")
    return with_text.select(
        F.coalesce("document_number", F.col("id").cast("string")).alias("id"),
        "text",
        iso_date(F.col("publication_date")).alias("publication_date"),
        "title",
        "type",
        or_empty(joined_names(F.col("agencies"), "name")).alias("agency_names"),
        or_empty(joined_texts(F.col("topics"))).alias("topics"),
        "html_url",
    )


def mail_collection(mail: DataFrame) -> DataFrame:
    """The archive without copies: the earliest message of every text, with blanks for nulls."""
    first = exact_dedupe(
        mail,
        "_text",
        ["timestamp", "_filename"],
        ["From", "To", "X-From", "X-To", "X-cc", "X-Origin", "_user", "Subject", "_folder", "Message-ID", "timestamp"],
    )
    filled = [or_empty(F.col(f"`{c}`")).alias(c) for c in ("From", "To", "X-From", "X-To", "X-cc", "X-Origin")]
    return first.select(
        F.col("_text").alias("text"),
        *filled,
        or_empty(part_after_at(F.col("From"))).alias("from-domain"),
        F.col("_user").alias("user"),
        "Subject",
        F.col("_folder").alias("folder"),
        "Message-ID",
        archive_clamp(F.col("timestamp")).alias("timestamp"),
        "copies",
    )


def call_dimensions(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls by id and speakers by id, of the calls that have metadata; a later entry wins.

    ``calls`` needs a ``seq`` column with the load order.
    """
    known = calls.filter(F.col("metaData").isNotNull())
    call = latest_by_key(known.select("metaData.*", "seq"), "id", ["seq"]).drop("seq")
    parties = known.select("seq", F.posexplode("parties").alias("pos", "p")).select("seq", "pos", "p.*")
    spoke = parties.filter(F.col("speakerId").isNotNull() & (F.col("speakerId") != ""))
    speaker = latest_by_key(spoke, "speakerId", ["seq", "pos"]).drop("seq", "pos")
    return call, speaker


def call_utterances(transcripts: DataFrame) -> DataFrame:
    """One row per utterance: text, times as shares of the call, topic and speaker."""
    last_end = spoken(F.element_at("transcript", -1)["sentences"])[2].cast("double")
    rows = transcripts.select(
        F.col("callId").alias("call_id"),
        F.nullif(last_end, F.lit(0.0)).alias("whole"),
        F.posexplode("transcript").alias("pos", "u"),
    )
    text, start, end = spoken(F.col("u.sentences"))
    flat = rows.select(
        "call_id",
        "pos",
        F.col("u.speakerId").alias("speaker_id"),
        F.col("u.topic").alias("utterance_topic"),
        text.alias("utterance"),
        (start.cast("double") / F.col("whole")).alias("relative_start"),
        (end.cast("double") / F.col("whole")).alias("relative_end"),
    )
    return flat


def enriched_calls(transcripts: DataFrame, calls: DataFrame) -> DataFrame:
    """Utterances with their speaker and call; an unknown key gives nulls."""
    call, speaker = call_dimensions(calls)
    rows = lookup(
        call_utterances(transcripts),
        speaker,
        "speakerId",
        {
            "speaker_id": {
                "name": "speaker_name",
                "emailAddress": "speaker_email",
                "affiliation": "speaker_affiliation",
            }
        },
    )
    return lookup(
        rows,
        call,
        "id",
        {"call_id": {"title": "call_title", "started": "call_start_time", "url": "call_url"}},
    )


def ticket_table(tickets: DataFrame, users: DataFrame, organizations: DataFrame) -> DataFrame:
    """Tickets with the mail addresses of their three people, in the export's columns.

    Users and organizations that carry a ``seq`` load order may repeat an id; the last wins.
    """
    if "seq" in users.columns:
        users = latest_by_key(users, "id", ["seq"])
    if "seq" in organizations.columns:
        organizations = latest_by_key(organizations, "id", ["seq"])
    people = {
        f"{role}_id": {"email": f"{role}_email"} for role in ("requester", "submitter", "assignee")
    }
    rows = lookup(tickets, users, "id", people)
    rows = lookup(rows, organizations, "id", {"organization_id": {"name": "organization_name"}})
    return whitelist(rows, TICKET_COLUMNS)


def newsletter_posts(sheet: DataFrame) -> DataFrame:
    """Posts of a newsletter sheet: url in column 0, name in column 5, posts from 2 in steps of 4.

    A newsletter listed twice keeps its last line, at the place of its first one;
    ``line`` holds the line order. Posts are numbered in that order.
    """
    cols = [c for c in sheet.columns if c != "line"]
    posts = [[cols[i], cols[i + 1], cols[i + 2]] for i in range(2, 21, 4)]
    own = sheet.select("line", cols[0], cols[5], *[c for group in posts for c in group if c != cols[5]])
    named = own.withColumns(
        {
            "slug": strip(host_slug(F.col(cols[0]))),
            "name": strip(F.col(cols[5])),
        }
    ).filter(F.col("slug").isNotNull())
    rest = [c for c in named.columns if c not in (cols[0], "slug", "line")]
    last = named.groupBy("slug").agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), "line").alias("_last"), F.min("line").alias("line")
    )
    last = last.select("slug", "line", "_last.*")
    long = wide_to_long(last, posts, ["url", "title", "subtitle"], "post_no")
    clean = long.select(
        "line",
        "name",
        "post_no",
        strip(F.col("url")).alias("url"),
        or_empty(strip(F.col("title"))).alias("title"),
        or_empty(strip(F.col("subtitle"))).alias("subtitle"),
    ).filter(F.coalesce(F.col("url"), F.lit("")) != "")
    texts = clean.withColumn("text", title_and_subtitle(F.col("title"), F.col("subtitle")))
    return sequential_id(texts, ["line", "post_no"]).drop("line", "post_no")


def read_newsletter(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Posts of a landed sheet; ``columns`` declares its columns in their order."""
    return newsletter_posts(source_ids(read_csv(spark, path, columns, source=True), "line").drop(*SOURCE))


def read_proceedings(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """Papers of landed JSON lines, numbered by line; broken lines are left out and keep their number."""
    return proceedings(read_json_lines(spark, path, fields, source=True))


def proceedings(papers: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Papers with a numeric year, a text id, and ``N/A`` for what is missing.

    Numbers go by ``order_by`` or, without it, by the place in the source (``file, block, row``).
    """
    numbered = sequential_id(papers, order_by) if order_by else source_ids(papers)
    numbered = numbered.withColumns(
        {"year": F.col("year").try_cast("double"), "id": F.col("id").cast("string")}
    )
    columns = whitelist(numbered, PROCEEDINGS_COLUMNS)
    return fill_na(columns, [c for c in PROCEEDINGS_COLUMNS if c not in ("id", "year")])


def commit_collection(*logs: DataFrame) -> DataFrame:
    """Commits of many repositories under one dense id, so ids of two repositories never meet."""
    return sequential_id(reduce(DataFrame.unionByName, logs), ["repo", "committed_at", "hash"], start=1)


def comment_rows(comments: DataFrame) -> DataFrame:
    """Each comment of a forum thread once, with its depth under the post."""
    tree = flatten_tree(comments.drop("depth"), "id", "parent_id")
    return tree.select(
        "id",
        F.col("body").alias("text"),
        deleted_author(F.col("author")).alias("author"),
        "score",
        "depth",
        from_epoch(F.col("created_utc")).alias("created_at"),
    )


def embedded_questions(items: DataFrame, vec: str = "title_embedding") -> DataFrame:
    """Stored documents with the id as text and the vector in its own column."""
    return items.withColumns(
        {"record_id": F.col("_id").cast("string"), "embedding": F.col(vec)}
    ).drop("_id", vec)


def page_links(pages: DataFrame) -> DataFrame:
    """Every link of every page as an edge: ``src``, ``pos`` on the page, ``dst`` resolved."""
    links = pages.select(F.col("url").alias("src"), F.posexplode(hrefs(F.col("html"))).alias("pos", "href"))
    return links.withColumn("dst", resolve(F.col("src"), F.col("href"))).filter("dst IS NOT NULL")


def paper_record(url: str, html: str) -> list[Column]:
    """A paper's page as columns: title, authors, year, link; null where the page has none."""
    page = F.col(html)
    return [
        F.col(url).alias("url"),
        F.nullif(visible_text(block_with_id(page, "h2", "title")), F.lit("")).alias("title"),
        F.transform(
            F.regexp_extract_all(
                F.array_join(blocks_with_class(page, "p", "lead"), " "),
                F.lit(r"(?is)<a\b[^>]*>(.*?)</a\s*>"),
                F.lit(1),
            ),
            visible_text,
        ).alias("authors"),
        visible_text(labelled_block(page, "Year:")).alias("year"),
        F.try_element_at(hrefs(labelled_block(page, "URL:")), F.lit(1)).alias("link"),
    ]


def event_papers(pages: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of the papers that event pages point to, and the ones that gave no title.

    ``events`` are edges from event pages to papers (``src``, ``dst``).
    """
    wanted = events.select(F.col("dst").alias("url")).distinct()
    found = pages.join(wanted, "url", "left_semi").select(*paper_record("url", "html"))
    missing = wanted.join(pages.select("url"), "url", "left_anti").withColumn("reason", F.lit("no page"))
    untitled = found.filter("title IS NULL").select("url", F.lit("no title").alias("reason"))
    return found.filter("title IS NOT NULL"), missing.unionByName(untitled)


def document_chunks(documents: DataFrame, max_chars: int = 800) -> DataFrame:
    """Chunks of titled documents under one dense id, in source order if documents know their place, else by file name."""
    order = SOURCE if set(SOURCE) <= set(documents.columns) else ("filename",)
    rows = chunk(documents, "text", max_chars).withColumnRenamed("chunk_text", "text")
    return sequential_id(rows, [*order, "chunk_no"]).select(
        "id", "text", "title", "filename", "heading", "page_num"
    )


def class_table(objects: DataFrame, class_name: str, properties: list[str]) -> DataFrame:
    """One class of a vector store: id, vector and the chosen text properties as columns."""
    rows = objects.filter(F.col("class") == class_name)
    return rows.select(
        "id",
        F.col("vector").alias("embedding"),
        *[F.try_element_at(F.col("properties"), F.lit(p)).alias(p) for p in properties],
    )


