"""Comment trees, link reach and connected groups, by joins that repeat until done.

Every round is cut from its lineage by a reliable checkpoint, so the plan does
not grow and a lost executor does not repeat earlier rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.skew import HOT_ROWS, hot_keys_of, spread_join
from weftline.storage import cut


def flatten_tree(df: DataFrame, id_col: str, parent_col: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every node once, with its ``root`` and ``depth`` (0 for a root).

    A node whose parent is not in the table is a root of its own. Each round
    doubles the distance a node has climbed, so depth d takes log2(d) rounds,
    and only nodes that have not met their root go on. Nodes on a cycle never
    do; they come out with null root and depth.
    """
    nodes = df.select(F.col(id_col).alias("node"), F.col(parent_col).alias("parent"))
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("_known"))
    linked = spread_join(nodes, known, "parent", "node", "left", hot_rows)
    child = F.col("_known").isNotNull()
    # A node's furthest ancestor so far, the steps up to it, and whether it is a root.
    state = cut(
        linked.select(
            "node",
            F.when(child, F.col("parent")).otherwise(F.col("node")).alias("up"),
            F.when(child, 1).otherwise(0).alias("steps"),
            (~child).alias("top"),
        )
    )
    n = state.count()
    rounds_left = max(1, n).bit_length() + 1
    closed, climbing = [state.filter("top")], state.filter("NOT top")
    while rounds_left and not climbing.isEmpty():
        ahead = reduce(DataFrame.unionByName, [*closed, climbing]).select(
            F.col("node").alias("up"),
            F.col("up").alias("next"),
            F.col("steps").alias("more"),
            F.col("top").alias("next_top"),
        )
        hot = hot_keys_of(climbing, "up", hot_rows, n)
        moved = cut(
            spread_join(climbing, ahead, "up", "node", "inner", hot=hot, n_rows=0).select(
                "node",
                F.col("next").alias("up"),
                (F.col("steps") + F.col("more")).alias("steps"),
                F.col("next_top").alias("top"),
            )
        )
        closed.append(moved.filter("top"))
        climbing = moved.filter("NOT top")
        rounds_left -= 1
    placed = reduce(DataFrame.unionByName, [*closed, climbing]).select(
        F.col("node").alias(id_col),
        F.when(F.col("top"), F.col("up")).alias("root"),
        F.when(F.col("top"), F.col("steps")).alias("depth"),
    )
    return df.join(placed, id_col)


def reach(edges: DataFrame, start: DataFrame, max_hops: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All nodes that can be reached from ``start`` (column ``node``) and in how many ``hops``.

    Breadth first; every node is expanded once. Without ``max_hops`` it runs
    until nothing new is found. Edges have the columns ``src`` and ``dst``; they
    are written once and read every hop.
    """
    edges = cut(edges.select("src", "dst"))
    hot = hot_keys_of(edges, "src", hot_rows, edges.count())
    frontier = cut(start.select("node").distinct().withColumn("hops", F.lit(0)))
    levels, hops = [frontier], 0
    while max_hops is None or hops < max_hops:
        ahead = spread_join(
            edges, frontier.select(F.col("node").alias("src")), "src", "dst", "inner", hot=hot, n_rows=0
        )
        seen = reduce(DataFrame.unionByName, levels).select("node")
        frontier = cut(
            ahead.select(F.col("dst").alias("node"))
            .distinct()
            .join(seen, "node", "left_anti")
            .withColumn("hops", F.lit(hops + 1))
        )
        if frontier.isEmpty():
            break
        hops += 1
        levels.append(frontier)
        if len(levels) > 16:
            levels = [cut(reduce(DataFrame.unionByName, levels))]
    return reduce(DataFrame.unionByName, levels)


def connected_groups(edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The smallest node of the connected group of every node that has an edge: ``node, label``.

    Each round takes the smallest label around a node, then the label of that
    label, until none changes. Minima are taken before the shuffle, so a hub
    costs no more than other nodes.
    """
    both = cut(
        edges.selectExpr("src AS a", "dst AS b").unionByName(edges.selectExpr("dst AS a", "src AS b")).distinct()
    )
    n = both.count()
    hot = hot_keys_of(both, "b", hot_rows, n)
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")
    ))
    while True:
        around = spread_join(
            both, labels.select(F.col("node").alias("b"), "label"), "b", "a", "inner", hot=hot, n_rows=0
        ).groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(around, labels["node"] == around["a"]).select(
            "node", "label", F.least("label", "m").alias("near")
        )
        if n >= hot_rows:
            lower = cut(lower)  # read for the count of hot labels and for the join
        far = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        hot_labels = hot_keys_of(lower, "near", hot_rows, n)
        jumped = cut(
            spread_join(lower, far, "near", "node", "inner", hot=hot_labels, n_rows=0).select(
                "node", F.least("near", "far").alias("label"), (F.least("near", "far") < F.col("label")).alias("moved")
            )
        )
        labels = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return labels
