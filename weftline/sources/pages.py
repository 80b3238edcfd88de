"""Landed API pages: one JSON envelope per page, records in an inner array."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed schemas of the envelopes the jobs read.
REGISTER_PAGE = (
    "results ARRAY<STRUCT<document_number STRING, id STRING, abstract STRING, title STRING, "
    "publication_date STRING, type STRING, agencies ARRAY<STRUCT<name STRING>>, "
    "topics ARRAY<STRING>, html_url STRING>>"
)
TRANSCRIPT_PAGE = (
    "callTranscripts ARRAY<STRUCT<callId STRING, transcript ARRAY<STRUCT<speakerId STRING, "
    "topic STRING, sentences ARRAY<STRUCT<start BIGINT, end BIGINT, text STRING>>>>>>, "
    "records STRUCT<cursor STRING>"
)
CALL_PAGE = (
    "calls ARRAY<STRUCT<metaData STRUCT<id STRING, title STRING, started STRING, url STRING>, "
    "parties ARRAY<STRUCT<speakerId STRING, name STRING, emailAddress STRING, affiliation STRING>>>>, "
    "records STRUCT<cursor STRING>"
)
SPEAKER_PAGE = "users ARRAY<STRUCT<id STRING, emailAddress STRING>>, records STRUCT<cursor STRING>"
TICKET_PAGE = (
    "content STRUCT<tickets ARRAY<STRUCT<url STRING, id BIGINT, created_at STRING, type STRING, "
    "subject STRING, description STRING, requester_id BIGINT, submitter_id BIGINT, "
    "assignee_id BIGINT, organization_id BIGINT>>>"
)
USER_PAGE = "content STRUCT<users ARRAY<STRUCT<id BIGINT, email STRING>>>"
ORGANIZATION_PAGE = "content STRUCT<organizations ARRAY<STRUCT<id BIGINT, name STRING>>>"


def records(pages: DataFrame, array_col: str, load_order: str | None = None) -> DataFrame:
    """The records of all envelopes as flat columns; empty pages give no rows.

    ``load_order`` names a column to add that sorts records as they were landed:
    by page file, then by place on the page.
    """
    if load_order is None:
        return pages.select(F.explode(array_col).alias("r")).select("r.*")
    placed = pages.select(F.col("_metadata.file_path").alias("file"), F.posexplode(array_col).alias("pos", "r"))
    return placed.select("r.*", F.struct("file", "pos").alias(load_order))


def read_pages(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    array_col: str,
    multi_line: bool = True,
    load_order: str | None = None,
) -> DataFrame:
    """All records of the pages landed at ``path``: a page per file, or per line without ``multi_line``.

    Files replace the paging loop, so every page is read, however many there are.
    """
    pages = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return records(pages, array_col, load_order)


def missing_pages(pages: DataFrame, asked: str, cursor: str) -> DataFrame:
    """Cursors that were handed out but have no page: an empty result means the chain is whole.

    ``asked`` names the column with the cursor a page was fetched with (null for
    the first page), ``cursor`` the column or field with the next one.
    """
    handed_out = pages.select(F.col(cursor).alias("cursor")).filter("cursor IS NOT NULL").distinct()
    answered = pages.select(F.col(asked).alias("cursor")).filter("cursor IS NOT NULL")
    return handed_out.join(answered, "cursor", "left_anti")
