"""Near-duplicate texts: an exact Jaccard join of word shingles and its connected groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.shingle_join import grouped
from weftline.operators.skew import HOT_ROWS, spread_join
from weftline.storage import written


def near_dups(
    df: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    percent: int = 80,
    n_words: int = 5,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``id, keep_id`` for every row: rows to drop keep another id than their own.

    Two texts link when their sets of different ``n_words``-word shingles, in
    lower case, share ``percent`` of their union; linked texts form a group that
    keeps its smallest id. Nothing is left to chance, and the answer for two texts
    does not depend on the rest of the table. Equal sets are merged first. The
    others meet at the shingles with which their sets begin in one common order
    (``shingle_join``). Sets are never written: ``df`` is read several times, and
    they are taken from its texts again. A text without words links with nothing;
    a row without an id gets its group's.
    """
    docs = df.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("text"))
    rows, groups = grouped(docs, "text", "id", n_words, percent)
    rows = rows.select("id", "name")
    firsts = rows.filter("name IS NOT NULL").groupBy("name").agg(F.min("id").alias("id"))
    named = firsts.join(groups.select(F.col("node").alias("name"), "comp"), "name", "left")
    named = written(named.select("name", "id", F.coalesce("comp", "name").alias("comp")), "named")
    smallest = named.groupBy("comp").agg(F.min("id").alias("keep_id"))
    kept = spread_join(named.select("name", "comp"), smallest, "comp", "name", "inner", hot_rows, n_rows=named.count())
    kept = kept.select("name", "keep_id")
    return spread_join(rows, kept, "name", "id", "left", hot_rows, n_rows=rows.count()).select("id", F.coalesce("keep_id", "id").alias("keep_id"))
