"""Splitting documents into chunks, and rendering found chunks as a prompt context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HEADING = r"^#{1,6} +([^\n]*)"


def _pieces(text: Column) -> Column:
    """A document cut at headings and page breaks, each piece with its heading and page.

    The fold runs over the few pieces of one document, not over its lines.
    """
    raw = F.filter(F.split(text, r"(?<=\f)|(?m)(?=^#{1,6} )"), lambda p: p != "")
    piece = "STRUCT<text: STRING, heading: STRING, page_num: INT>"
    start = F.struct(
        F.array().cast(f"ARRAY<{piece}>").alias("done"),
        F.lit(None).cast("string").alias("heading"),
        F.lit(1).alias("page_num"),
    )

    def add(acc: Column, p: Column) -> Column:
        heading = F.coalesce(
            F.nullif(F.rtrim(F.regexp_extract(p, _HEADING, 1)), F.lit("")), acc["heading"]
        )
        row = F.struct(p.alias("text"), heading.alias("heading"), acc["page_num"].alias("page_num"))
        return F.struct(
            F.concat(acc["done"], F.array(row)).alias("done"),
            heading.alias("heading"),
            (acc["page_num"] + F.when(F.endswith(p, F.lit("\f")), 1).otherwise(0)).alias("page_num"),
        )

    whole = F.struct(
        text.alias("text"), F.lit(None).cast("string").alias("heading"), F.lit(1).alias("page_num")
    )
    undivided = ~(F.contains(text, F.lit("\f")) | F.contains(text, F.lit("\n#")) | F.startswith(text, F.lit("#")))
    return F.when(undivided, F.array(whole)).otherwise(
        F.aggregate(raw, start, add, lambda acc: acc["done"])
    )


def _packed(text: Column, max_chars: int) -> Column:
    """As many whole lines as fit into ``max_chars``; a longer line breaks at its last blank,
    or where it must. A chunk keeps the line end or blank it was cut at."""
    n = f".{{1,{max_chars}}}"
    return F.regexp_extract_all(text, F.lit(rf"(?s){n}(?:\n|\z)|{n}[ \t]|{n}"), F.lit(0))


def chunk(df: DataFrame, text: str, max_chars: int = 800) -> DataFrame:
    """One row per chunk: ``chunk_no`` (from 0), ``chunk_text``, ``heading``, ``page_num``.

    Other columns stay. A chunk never crosses a heading or a page break, and the
    chunks of a document, joined in order, are the document. All work is within
    the row: nothing is shuffled.
    """
    keep = [c for c in df.columns if c != text]
    chunks = F.flatten(
        F.transform(
            _pieces(F.col(text)),
            lambda p: F.transform(
                _packed(p["text"], max_chars),
                lambda t: F.struct(
                    t.alias("chunk_text"), p["heading"].alias("heading"), p["page_num"].alias("page_num")
                ),
            ),
        )
    )
    return df.select(*keep, F.posexplode(chunks).alias("chunk_no", "_c")).select(
        *keep, "chunk_no", "_c.*"
    )


def rag_context(hits: DataFrame, fields: Sequence[str], question: str | None = None) -> DataFrame:
    """The ranked rows of each query as one JSON text, best first, with the question below.

    A query has at most ``k`` rows here, by the search before.
    """
    listed = F.array_sort(F.collect_list(F.struct("rank", *fields)))
    shown = F.to_json(F.transform(listed, lambda r: F.struct(*[r[f].alias(f) for f in fields])))
    aggs = [listed.alias("_rows")] + ([F.first(question).alias("_question")] if question else [])
    rows = hits.groupBy("qid").agg(*aggs)
    shown = F.to_json(
        F.transform("_rows", lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    )
    prompt = F.concat(F.lit("Context:\n"), shown)
    if question:
        prompt = F.concat(prompt, F.lit("\n\nQuestion: "), F.col("_question"))
    return rows.select("qid", F.size("_rows").alias("n_rows"), prompt.alias("prompt"))
