"""Mail archives and mailboxes.

Only the MIME walk itself runs in Python workers, on Arrow batches of whole
messages. Splitting files, picking the body, dates, threads and labels are
Spark columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from email import message_from_bytes, message_from_string
from email.header import decode_header
from email.message import Message
from email.parser import HeaderParser

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.dates import mail_instant, message_instant
from weftline.functions.html import visible_text
from weftline.functions.text import thread_id
from weftline.operators.reshape import label_flags
from weftline.sources.lines import SOURCE, numbered_lines, source_ids

# The parser's output, as Arrow types and as DDL. A mailbox needs the body parts
# of a message, an archive its payload as it stands; the other stays unread.
_STRING = pa.string()
_HEADERS = pa.map_(_STRING, _STRING)
_PART = pa.struct(
    [("type", _STRING), ("attachment", pa.bool_()), ("decoded", _STRING), ("raw", _STRING)]
)
_AS_PARTS = {"headers": _HEADERS, "multipart": pa.bool_(), "parts": pa.list_(_PART)}
_AS_PAYLOAD = {"headers": _HEADERS, "payload": _STRING}
_AS_HEADERS = {"headers": _HEADERS}
_DDL = {
    "headers": "MAP<STRING, STRING>",
    "multipart": "BOOLEAN",
    "parts": "ARRAY<STRUCT<type: STRING, attachment: BOOLEAN, decoded: STRING, raw: STRING>>",
    "payload": "STRING",
}

# Bytes of messages that are parsed together, one message at least: an Arrow batch of
# whole messages may be large, and its parsed form is several times as large.
PARSED_AT_ONCE = 2 << 20

# Tasks for each core that read the files of an archive, at most.
TASKS_A_CORE = 4

# The labels that become columns, the headers the archive keeps.
MAILBOX_LABELS = (
    "Inbox",
    "Important",
    "Opened",
    "Unread",
    "Archived",
    "Trash",
    "Spam",
    "Category_Updates",
    "Category_Personal",
    "Category_Promotions",
    "Category_Forums",
    "Category_Purchases",
    "IMAP_Forwarded",
)
ARCHIVE_HEADERS = (
    "Message-ID",
    "Date",
    "From",
    "To",
    "Cc",
    "Bcc",
    "Subject",
    "Mime-Version",
    "Content-Type",
    "Content-Transfer-Encoding",
    "X-From",
    "X-To",
    "X-cc",
    "X-bcc",
    "X-Folder",
    "X-Origin",
    "X-FileName",
)


def _decoded(part: Message) -> str | None:
    """The text of one leaf in its declared charset; null when the charset is unknown."""
    body = part.get_payload(decode=True)
    if body is None:
        return None
    try:
        return body.decode(part.get_content_charset() or "utf-8", errors="replace")
    except LookupError:
        return None


def _text(value: object) -> str:
    """Text that Arrow can hold: undecodable bytes become replacement marks."""
    return str(value).encode("utf-8", errors="replace").decode("utf-8")


def _headers(message: Message) -> list[tuple[str, str]]:
    """Headers by name; a repeated one keeps its first value."""
    first: dict[str, str] = {}
    for name, value in message.items():
        first.setdefault(_text(name), _text(value))
    return list(first.items())


def _leaf(part: Message) -> dict:
    decoded = _decoded(part)
    return {
        "type": part.get_content_type(),
        "attachment": "attachment" in str(part.get("Content-Disposition")),
        "decoded": decoded,
        "raw": _text(part.get_payload()) if decoded is None else None,
    }


def _as_parts(raw: bytes) -> dict:
    message = message_from_bytes(raw)
    return {
        "headers": _headers(message),
        "multipart": message.is_multipart(),
        "parts": [_leaf(p) for p in message.walk() if not p.is_multipart()],
    }


def _as_headers(raw: bytes) -> dict:
    return {"headers": _headers(HeaderParser().parsestr(raw.decode("latin-1")))}


def _as_payload(raw: bytes) -> dict:
    message = message_from_string(raw.decode("latin-1"))
    whole = message.get_payload()
    return {"headers": _headers(message), "payload": _text(whole) if isinstance(whole, str) else None}


def _few(batch: pa.RecordBatch, content: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``PARSED_AT_ONCE`` bytes of messages."""
    at, held = 0, 0
    for k, size in enumerate(pc.binary_length(batch.column(content)).to_pylist()):
        if k > at and held + size > PARSED_AT_ONCE:
            yield batch.slice(at, k - at)
            at, held = k, 0
        held += size
    yield batch.slice(at)


def _parsed(df: DataFrame, content: str, types: dict, parse: Callable[[bytes], dict]) -> DataFrame:
    """The other columns of ``df`` and the parsed message of each row, by Arrow batches."""
    keep = [c for c in df.columns if c != content]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in _few(batch, content):
                messages = [parse(raw.as_py()) for raw in part.column(content)]
                made = [pa.array([m[name] for m in messages], kind) for name, kind in types.items()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], names=[*keep, *types])

    ddl = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    rows = df.filter(F.col(content).isNotNull()).select(*keep, content)
    return rows.mapInArrow(batches, ", ".join([*ddl, *(f"{n} {_DDL[n]}" for n in types)]))


def parse_messages(df: DataFrame, content: str) -> DataFrame:
    """Headers and body parts of the raw messages in ``content`` (binary)."""
    return _parsed(df, content, _AS_PARTS, _as_parts)


def parse_archived(df: DataFrame, content: str) -> DataFrame:
    """Headers and undivided payload of archived messages, all bytes read as Latin-1."""
    return _parsed(df, content, _AS_PAYLOAD, _as_payload)


def parse_headers(df: DataFrame, content: str) -> DataFrame:
    """Headers alone of archived messages; what follows them is neither parsed nor passed on."""
    return _parsed(df, content, _AS_HEADERS, _as_headers)


def header(name: str, headers: str = "headers") -> Column:
    """A header by name, in any case."""
    found = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name.lower())
    return F.try_element_at(found, F.lit(1))["value"]


def _plain_header(value: str | None) -> str:
    def piece(text: str | bytes, charset: str | None) -> str:
        if isinstance(text, str):
            return text
        try:
            return text.decode(charset or "utf-8", errors="strict" if charset else "replace")
        except (LookupError, UnicodeDecodeError):
            return text.decode("utf-8", errors="replace")

    return "" if value is None else _text(" ".join(piece(t, c) for t, c in decode_header(value)))


def decoded_header(c: Column) -> Column:
    """Encoded words of a header as plain text, pieces joined by a space; null gives ''.

    Only headers that hold an encoded word go to Python.
    """

    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        return values.map(_plain_header)

    encoded = F.when(F.contains(c, F.lit("=?")), c)
    return F.when(F.contains(c, F.lit("=?")), decode(encoded)).otherwise(F.coalesce(c, F.lit("")))


def body(parts: str = "parts", multipart: str = "multipart") -> Column:
    """The readable body of a message.

    Of several parts the first plain text that is no attachment wins; without
    one, the first HTML part that shows any text. A message of one part is read
    by its own type, and types other than text give ''.
    """
    usable = F.filter(parts, lambda p: ~p["attachment"] & p["decoded"].isNotNull())
    plain = F.filter(usable, lambda p: p["type"] == "text/plain")
    shown = F.filter(
        F.transform(
            F.filter(usable, lambda p: p["type"] == "text/html"),
            lambda p: visible_text(p["decoded"]),
        ),
        lambda t: t != "",
    )
    only = F.try_element_at(F.col(parts), F.lit(1))
    single = F.when(only["type"] == "text/plain", F.coalesce(only["decoded"], only["raw"])).when(
        only["type"] == "text/html",
        F.coalesce(visible_text(only["decoded"]), only["raw"]),
    )
    several = F.coalesce(
        F.try_element_at(plain, F.lit(1))["decoded"], F.try_element_at(shown, F.lit(1))
    )
    return F.coalesce(F.when(F.col(multipart), several).otherwise(single), F.lit(""))


def archive_rows(messages: DataFrame) -> DataFrame:
    """One flat row per archived message: owner, folder, text, fixed headers, instant."""
    return messages.select(
        "_user",
        "_folder",
        "_filename",
        F.col("payload").alias("_text"),
        *[F.try_element_at(F.col("headers"), F.lit(h)).alias(h) for h in ARCHIVE_HEADERS],
        mail_instant(F.try_element_at(F.col("headers"), F.lit("Date"))).alias("timestamp"),
    )


def read_mail_files(spark: SparkSession, path: str) -> DataFrame:
    """Mail archive unpacked as ``<root>/<user>/<folders...>/<file>`` below ``path``.

    Folders are not rows. User and folder come from the path below the root,
    the name of the first path segment under ``path``.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    base = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # Spark counts a small file as 4 MB, which makes a task of every 32 files; rows pass one by one, so a task may read any number.
    files = files.coalesce(TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    local = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?", "")
    steps = F.split(F.substring(local, len(base.rstrip("/")) + 2, 2**31 - 1), "/")
    named = files.select(
        F.try_element_at(steps, F.lit(2)).alias("_user"),
        F.array_join(F.slice(steps, F.lit(3), F.greatest(F.size(steps) - 3, F.lit(0))), "/").alias("_folder"),
        F.array_join(steps, "/").alias("_filename"),
        "content",
    )
    return archive_rows(parse_archived(named, "content"))


def split_mailbox(spark: SparkSession, path: str) -> DataFrame:
    """One row of raw bytes per message, with its place; the file is split in parallel at its ``From `` lines."""
    raw = numbered_lines(spark, path, "\nFrom ")
    # The separator line ends at the first line end and is no part of the message.
    text = F.col("value").cast("binary")
    first_end = F.expr("instr(value, '\n')")
    return (
        raw.filter(first_end > 0)
        .select(*SOURCE, F.substring(text, F.octet_length(F.expr("substring(value, 1, instr(value, '\n'))")) + 1, F.octet_length(text)).alias("content"))
    )


def mailbox_rows(messages: DataFrame) -> DataFrame:
    """The mailbox table: ids, date, addresses, subject, body and one text flag per label.

    Messages that know their place get a dense ``id`` in source order.
    """
    placed = set(SOURCE) <= set(messages.columns)
    rows = (source_ids(messages) if placed else messages).select(
        *(["id"] if placed else []),
        header("message-id").alias("message_id"),
        thread_id(
            header("x-gm-thrid"), header("references"), header("in-reply-to"), header("message-id")
        ).alias("thread_id"),
        message_instant(header("date"), header("received")).alias("date"),
        decoded_header(header("from")).alias("from"),
        decoded_header(header("to")).alias("to"),
        decoded_header(header("subject")).alias("subject"),
        body().alias("body"),
        header("x-gmail-labels").alias("labels"),
    )
    return label_flags(rows, "labels", MAILBOX_LABELS, as_text=True).drop("labels")


def read_mbox(spark: SparkSession, path: str) -> DataFrame:
    return mailbox_rows(parse_messages(split_mailbox(spark, path), "content"))
