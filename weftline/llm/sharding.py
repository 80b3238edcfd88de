"""Deal documents to shards of equal size by balanced label propagation, with DataFrame operations only.

Documents that share a link key (equal texts, by default) are neighbours. All
start in the shard of a hash. In every round the neighbours' shards are counted
per key, and documents want to move to the shard that holds most of theirs. A
matrix of wishes from shard to shard, of fixed size, then gives each shard the
share of wishes it can take without exceeding its capacity, counting who leaves;
keys are admitted whole by a hash, very large ones document by document. A shard
that is full is no goal, and a large key stays in the full shards where it has
settled, so a key larger than a shard fills one after the other.

At the end counts are made exact: in each shard the documents of the largest
groups rank first, and what ranks behind the shard's quota, documents without
neighbours before any others, fills the shards that are short.

The law is ``rows``: counts differ by one at most. Null texts have the size of
empty ones and link with them. Repeated rows are rows of their own. Null ids are
placed too. Empty table: no rows. Further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.tables import kept

SHARDS, ROUNDS = 24, 5

#: Buckets of a shard's documents of one rank class, and the group size from which a group is dealt over them.
BUCKETS, WIDE_GROUP = 1024, 128


def admitted(wishes: dict[tuple[int, int], int], room: list[int]) -> list[float]:
    """For each shard the share of wishes it can take, given how many leave it for shards with room."""
    shards = range(len(room))
    share = [1.0] * len(room)
    into = [sum(n for (_, b), n in wishes.items() if b == s) for s in shards]
    for _ in range(100):  # falls to a fixed point
        leaving = [sum(n * share[b] for (a, b), n in wishes.items() if a == s) for s in shards]
        following = [min(share[s], max(0.0, (room[s] + leaving[s]) / into[s])) if into[s] else share[s] for s in shards]
        if following == share:
            break
        share = following
    return share


def _pick(values: list, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def _chance(*cols: Column | str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / float(1 << 30)


def propagated(linked: DataFrame, shards: int, capacity: int, rounds: int) -> DataFrame:
    """``linked`` (with ``id, link, shard``) after the rounds."""
    for turn in range(rounds):
        votes = kept(linked.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n")), "votes")
        used = [0] * shards
        for row in votes.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # a row per shard
            used[row["shard"]] = row["n"]
        full = [n >= 0.98 * capacity for n in used]
        is_full = _pick(full, F.col("shard"))
        goal = votes.filter(~is_full).groupBy("link").agg(
            F.max(F.struct("n", F.xxhash64("link", "shard").alias("tie"), "shard")).alias("best")
        ).select("link", F.col("best.shard").alias("goal"))
        settled = is_full & (F.col("n") * 4 >= F.lit(capacity))
        wish = kept(
            votes.withColumn("settled", settled).filter(~F.col("settled")).join(goal, "link").filter(F.col("shard") != F.col("goal"))
            .select("link", "shard", "goal", "n"),
            "wishes",
        )
        asked = {(r["shard"], r["goal"]): r["n"] for r in wish.groupBy("shard", "goal").agg(F.sum("n").alias("n")).collect()}
        if not asked:
            break
        share = admitted(asked, [capacity - n for n in used])
        wide = F.col("n") * 8 > F.lit(capacity)
        wide = F.coalesce(wide, F.lit(False))
        moved = linked.join(wish.hint("merge"), ["link", "shard"], "left")
        chance = F.when(wide, _chance("id", F.lit(turn))).otherwise(_chance("link", F.lit(turn)))
        goes = F.col("goal").isNotNull() & (chance < _pick(share, F.col("goal")))
        linked = kept(
            moved.withColumn("shard", F.when(goes, F.col("goal")).otherwise(F.col("shard")).cast("int")).select(*linked.columns), "linked"
        )
    return linked


def balanced(rows: DataFrame, shards: int) -> DataFrame:
    """Exact counts and gapless slots; ``rows`` has ``id, link, shard, group_rows`` (neighbours in the shard)."""
    kind = F.when(F.col("group_rows") > 1, F.floor(F.log2("group_rows"))).otherwise(0)
    spread = F.when(F.col("group_rows") > WIDE_GROUP, F.xxhash64("id", "link")).otherwise(F.xxhash64("link"))
    spread = F.when(kind == 0, F.xxhash64("id", "link")).otherwise(spread)
    rows = kept(rows.withColumn("bucket", ((F.lit(63) - kind) * BUCKETS + F.pmod(spread, F.lit(BUCKETS))).cast("int")), "ranked")
    sizes = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = kept(sizes.select("shard", "bucket", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    count = [0] * shards
    for row in offsets.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # a row per shard
        count[row["shard"]] = row["n"]
    total = sum(count)
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    over, short, surplus, ends = 0, 0, [], []
    for s in range(shards):
        surplus.append(over)
        over += max(0, count[s] - quota[s])
        short += max(0, quota[s] - count[s])
        ends.append(short)
    within = Window.partitionBy("shard", "bucket").orderBy("link", "id")
    placed = rows.withColumn("nth", F.row_number().over(within)).join(offsets.select("shard", "bucket", "offset"), ["shard", "bucket"])
    rank = F.col("offset") + F.col("nth") - 1
    placed = placed.withColumn("rank", rank).withColumn("extra", F.col("rank") - _pick(quota, F.col("shard")) + _pick(surplus, F.col("shard")))
    moves = F.col("rank") >= _pick(quota, F.col("shard"))
    goal = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= F.col("extra")))
    begins = [e - max(0, q - c) for e, q, c in zip(ends, quota, count, strict=True)]
    placed = placed.withColumn("goal", F.when(moves, goal))
    slot = _pick(count, F.col("goal")) + F.col("extra") - _pick(begins, F.col("goal"))
    return placed.withColumn("slot", F.when(moves, slot).otherwise(F.col("rank")).cast("long")).withColumn(
        "shard", F.coalesce("goal", "shard").cast("int")
    )


def deal(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = kept(
        docs.select(
            F.col(id_col).alias("id"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
            F.xxhash64(body).alias("link"),
        ),
        "rows",
    )
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "link", F.lit("start")), F.lit(shards)).cast("int"))
    several = rows.groupBy("link").agg(F.count(F.lit(1)).alias("of")).filter("of > 1").select("link")
    several = kept(several, "several").hint("merge")
    linked = propagated(kept(rows.join(several, "link", "left_semi"), "linked"), shards, rows.count() // shards, rounds)
    groups = linked.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("group_rows"))
    linked = linked.join(groups.hint("merge"), ["link", "shard"])
    alone = rows.join(several, "link", "left_anti").withColumn("group_rows", F.lit(1).cast("long"))
    return balanced(alone.unionByName(linked), shards).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
