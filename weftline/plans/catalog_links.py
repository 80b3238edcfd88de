"""Queries over pages, trees and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import html
from weftline.operators import chunk as chunking
from weftline.operators import graph
from weftline.plans import recipes
from weftline.plans.catalog import query, table

# The page text in DuckDB: the references the tables hold, `&amp;` last.
_TEXT = r"""trim(regexp_replace(replace(replace(replace(replace(
  regexp_replace(regexp_replace(regexp_replace({0},
    '(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>', ' ', 'g'),
    '(?s)<!--.*?-->', ' ', 'g'), '(?s)</?[A-Za-z!][^>]*>', ' ', 'g'),
  '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))"""


@query(f"SELECT page_id, {_TEXT.format('html')} AS text FROM pages")
def html_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", html.visible_text(F.col("html")).alias("text"))


@query(
    r"""
    WITH l AS (
      SELECT url AS src, links, unnest(range(len(links))) AS i FROM (
        SELECT url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages))
    SELECT src, i::INTEGER AS pos, links[i + 1] AS href,
           regexp_extract(src, '^(https?://[^/?#]*)', 1) || links[i + 1] AS dst FROM l
    """
)
def page_links(spark: SparkSession, d: str) -> DataFrame:
    return recipes.page_links(table(spark, d, "pages"))


@query(
    f"""
    SELECT page_id, url, {_TEXT.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
           nullif({_TEXT.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '') AS heading,
           len(regexp_extract_all(html, '<a href="([^"]*)"', 1))::INTEGER AS n_links,
           NULL::VARCHAR AS year
    FROM pages
    """
)
def page_record(spark: SparkSession, d: str) -> DataFrame:
    page = F.col("html")
    return table(spark, d, "pages").select(
        "page_id",
        "url",
        html.first_block_text(page, "title").alias("title"),
        html.first_block_text(page, "h1").alias("heading"),
        F.size(html.hrefs(page)).alias("n_links"),
        html.visible_text(html.labelled_block(page, "Year:")).alias("year"),
    )


@query(
    r"""
    WITH l AS (SELECT page_id, unnest(regexp_extract_all(html,
               '(?s)<li>(.*?)</li>', 1)) AS item FROM pages)
    SELECT page_id, regexp_extract(item, 'href="([^"]*)"', 1) AS href, count(*) AS n
    FROM l GROUP BY ALL
    """
)
def block_links(spark: SparkSession, d: str) -> DataFrame:
    """Links that stand inside one kind of element (here list items)."""
    items = F.flatten(F.transform(html.blocks(F.col("html"), "li"), html.hrefs))
    links = table(spark, d, "pages").select("page_id", F.explode(items).alias("href"))
    return links.groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


@query(
    r"""
    WITH RECURSIVE l AS MATERIALIZED (
      SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM pages),
    r(page_id, hops) USING KEY (page_id) AS (
      SELECT 0::BIGINT, 0
      UNION
      SELECT b.page_id, min(r.hops) + 2 FROM r JOIN l a ON a.page_id = r.page_id JOIN l b ON a.link = b.link
      WHERE b.page_id NOT IN (SELECT page_id FROM recurring.r)
      GROUP BY b.page_id)
    SELECT page_id, hops FROM r
    """
)
def link_reach(spark: SparkSession, d: str) -> DataFrame:
    """All pages that can be reached from page 0 over shared links, and how far off they are.

    Pages and links are the two kinds of nodes, so pages that share a link meet
    at the link and are never paired with each other.
    """
    links = (
        table(spark, d, "pages")
        .select(F.col("page_id"), F.explode(html.hrefs(F.col("html"))).alias("link"))
        .select(
            F.concat(F.lit("page:"), F.col("page_id").cast("string")).alias("p"),
            F.concat(F.lit("link:"), F.col("link")).alias("l"),
        )
        .distinct()
    )
    edges = links.selectExpr("p AS src", "l AS dst").unionByName(links.selectExpr("l AS src", "p AS dst"))
    start = spark.range(1).select(F.lit("page:0").alias("node"))
    found = graph.reach(edges, start)
    return found.filter(F.startswith("node", F.lit("page:"))).select(
        F.substring_index("node", ":", -1).cast("bigint").alias("page_id"), "hops"
    )


@query(
    """
    WITH RECURSIVE r AS (
      SELECT conv_id, turn, 0 AS depth FROM conversations WHERE turn = 0
      UNION ALL
      SELECT c.conv_id, c.turn, depth + 1 FROM r JOIN conversations c ON c.conv_id = r.conv_id AND c.turn = r.turn + 1)
    SELECT conv_id, turn, conv_id || ':0' AS root, depth::INTEGER AS depth FROM r
    """
)
def reply_tree(spark: SparkSession, d: str) -> DataFrame:
    turn = F.col("turn")
    rows = table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        F.concat_ws(":", "conv_id", "turn").alias("id"),
        F.when(turn > 0, F.concat_ws(":", "conv_id", turn - 1)).alias("parent_id"),
    )
    return graph.flatten_tree(rows, "id", "parent_id").select("conv_id", "turn", "root", "depth")


@query(
    r"""
    SELECT doc_id, i::INTEGER AS chunk_no, chunks[i + 1] AS chunk_text, NULL::VARCHAR AS heading, 1 AS page_num
    FROM (SELECT doc_id, chunks, unnest(range(len(chunks))) AS i FROM (
      SELECT doc_id, regexp_extract_all(text, '(?s).{1,800}(?:\n|\z)|.{1,800}[ \t]|.{1,800}') AS chunks FROM documents))
    """
)
def chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk(table(spark, d, "documents").select("doc_id", "text"), "text", 800)
