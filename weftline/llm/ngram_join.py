"""Near-duplicate documents by the exact Jaccard join of ``weftline.operators.shingle_join``.

Documents link when ``100 * intersection >= percent * union`` of their sets of
word n-grams. Null or blank texts have no shingle and link with nothing. Texts
below ``n`` words have their whole sequence as the one shingle. Repeated rows and
ids are rows of their own with the component of their set; a null id counts for no
component's number and gets its component's. Empty table: no rows. Further columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.tables import LABEL_BYTES, kept, sized
from weftline.operators.shingle_join import LAST_SHINGLES, grouped, tree_join

__all__ = ["near_duplicate_groups", "representatives", "tree_join"]


def near_duplicate_groups(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", n: int = 5, percent: int = 80,
    last_shingles: int = LAST_SHINGLES,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``, the smallest id of its group."""
    rows, comps = grouped(docs, text, id_col, n, percent, last_shingles)
    comps = sized(comps.withColumnRenamed("node", "name"), LABEL_BYTES)
    groups = kept(rows.filter("name IS NOT NULL").groupBy("name").agg(F.min("id").alias("least")).join(comps, "name", "left"), "groups")
    numbers = groups.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("least").alias("number"))
    by_name = groups.join(numbers, "comp", "left").select("name", F.coalesce("number", "least").alias("component_id"))
    return rows.join(by_name, "name", "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )


def representatives(docs: DataFrame, text: str = "text", id_col: str = "doc_id", n: int = 5, percent: int = 80) -> DataFrame:
    """One row of every group, all columns kept: the one with the smallest id, then text key; null ids come last.

    Rows are told apart by id and text, so an id may stand for several texts;
    rows that repeat both are one.
    """
    rows, comps = grouped(docs, text, id_col, n, percent)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    firsts = rows.filter("name IS NOT NULL").groupBy("name").agg(first).join(comps.withColumnRenamed("node", "name"), "name", "left")
    firsts = kept(firsts.select("name", "first", F.coalesce("comp", "name").alias("comp")), "firsts")
    stays = firsts.select("name", "comp").join(firsts.groupBy("comp").agg(F.min("first").alias("stay")), "comp").select("name", "stay")
    goes = ~(F.col("id").eqNullSafe(F.col("stay.id")) & (F.col("key") == F.col("stay.key")))
    copies = rows.join(stays, "name").filter(goes).select(F.col("id").alias("copy_id"), F.col("key").alias("copy_key")).distinct()
    copies = kept(copies, "copies")
    # the row travels as one column, so that its own names clash with none
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = docs.select(row, F.col(id_col).alias("id"), F.xxhash64(text).alias("key"))
    same = F.col("id").eqNullSafe(F.col("copy_id")) & (F.col("key") == F.col("copy_key"))
    left = marked.join(sized(copies, 32), same, "left_anti")
    if not rows.groupBy("id", "key").count().filter("count > 1").isEmpty():
        left = left.dropDuplicates(["id", "key"])
    return left.select("row.*")
