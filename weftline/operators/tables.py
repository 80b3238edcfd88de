"""Small helpers shared by the operators: kept intermediate tables, bounded batches, checked broadcasts, components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.storage import scratch_path

#: A side is broadcast only if its counted rows times its row width stay below this.
BROADCAST_BYTES = 32 << 20

#: A node with its label as a broadcast holds it; nodes in a file of a small graph's labels.
LABEL_BYTES, LABELS_A_FILE = 32, 100_000

#: Bytes of rows that a Python worker gets at once. A batch stands in the executor's buffers several times over.
BATCH_BYTES = 1 << 20

_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage is cut, columns can be pruned, lost executors cost a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def in_batches(df: DataFrame) -> DataFrame:
    """``df`` for Python workers: its session sends them rows some ``BATCH_BYTES`` at a time from now on.

    Spark alone counts rows, 10,000 at a time, whatever their length. A session
    that has a limit of its own keeps it.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_LIMIT, None) is None:
        conf.set(_BATCH_LIMIT, str(BATCH_BYTES))
    return df


def sized(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its counted size allows; else it is joined by a shuffle."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n * row_bytes <= BROADCAST_BYTES else df


def components(edges: DataFrame, a: str = "a", b: str = "b", start: DataFrame | None = None) -> DataFrame:
    """``node, comp`` for every node of the edges: the smallest node that can be reached.

    Rounds of smallest neighbouring label followed by the label of that label;
    minima are taken before the shuffle, so repeated edges cost little, and Spark
    splits skewed joins. Labels of
    a counted small graph are broadcast, and its rounds leave few files.
    ``start``: what this gave for some of the edges, to begin with.
    """
    both = kept(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).union(edges.select(F.col(b), F.col(a))), "edges")
    n = both.count()
    small = n * LABEL_BYTES <= BROADCAST_BYTES

    def round_kept(df: DataFrame) -> DataFrame:
        return kept(df.coalesce(1 + n // LABELS_A_FILE) if small else df, "labels")

    least = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m"))
    if start is not None:
        least = least.join(sized(start, LABEL_BYTES), "node", "left")
    labels = round_kept(least.select("node", F.least("node", "m", *([] if start is None else ["comp"])).alias("comp")))
    while True:
        near = (
            both.join(sized(labels.withColumnRenamed("node", "y"), LABEL_BYTES, n), "y")
            .groupBy(F.col("x").alias("node")).agg(F.min("comp").alias("near"))
        )
        lower = near.join(sized(labels, LABEL_BYTES, n), "node").select("node", "comp", F.least("comp", "near").alias("near"))
        far = sized(labels.select(F.col("node").alias("near"), F.col("comp").alias("far")), LABEL_BYTES, n)
        following = round_kept(
            lower.join(far, "near", "left").select(
                "node",
                F.least("near", F.coalesce("far", "near")).alias("comp"),
                (F.least("near", F.coalesce("far", "near")) < F.col("comp")).alias("moved"),
            )
        )
        labels = following.select("node", "comp")
        if following.filter("moved").isEmpty():
            return labels
