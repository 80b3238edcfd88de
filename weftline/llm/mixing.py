"""Mix sources to target weights from packed blocks, with DataFrame operations only.

* **Targets.** Sources in code-point order, null last, weigh ``weights`` in turn
  and share ``budget`` times all words. A target stops at ``most`` times its
  source's size; what is left over is shared again by weight.
* **Packing.** The words of a source stand end to end, documents in the order of
  a hash of the id, and are cut into blocks of ``block_words``; only the last
  block of a source is shorter. Places come from totals per hash bucket, so a
  source with any share of all rows is spread over many tasks.
* **Draws.** A source's target is a run of slots. Every slot draws its output
  shard by a hash, so the counts of a source over the shards are multinomial and
  the source's total is exact.
* **Permutation.** Each pass over a source maps its slots through a pseudorandom
  permutation of the block numbers (swap-or-not: in every round a number and its
  mirror change places if a hash of the larger says so), exact for every count
  and computed where it is needed. A pass takes no block twice, and there are at
  most ``most`` passes. Only the last slot of a pass may take part of a block;
  the short block comes after all others.
* **Join.** Slots and the documents' parts of blocks meet by source and block.

Reruns agree: all draws are hashes of the row or the slot and ``seed``. Null or
blank text: size 0, nothing taken. Null sources are one source. Repeated rows
are packed each; ids may be null. Without words nothing is taken and targets
are 0. Texts are read whole, however long, and split once. Empty table: no rows.
Further columns, whatever their names, are kept by ``mixed_documents`` and not
looked at else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import bound
from weftline.llm.tables import kept
from weftline.llm.words import WORD
from weftline.operators.ids import sequential_id

WEIGHTS, BUDGET, MOST = (3, 1, 2), 1.5, 2
BLOCK_WORDS, SHARDS, SEED = 64, 64, 7

#: Buckets of a source's documents, slots that one row is unfolded into, slots of a task, rounds of the permutation.
BUCKETS, UNFOLDED, SLOTS_A_TASK, ROUNDS = 1024, 4096, 65_536, 12


def targets(sizes: DataFrame, weights: tuple[int, ...], budget: float, most: int) -> DataFrame:
    """``src, source, source_size, target`` from ``src, source, source_size``; two sums a round reach the driver."""
    ranked = sequential_id(sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], out="place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = kept(ranked.select("src", "source", "source_size", weight.alias("weight")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap, level = F.col("source_size") * float(most), 0.0
    while True:  # the level only rises, and a source that stops stays so
        stopped = cap <= F.col("weight") * level
        full, free = ranked.agg(F.sum(F.when(stopped, cap)), F.sum(F.when(~stopped, F.col("weight")))).first()
        following = (budget * total - (full or 0.0)) / free if free else level
        if following <= level:
            break
        level = following
    return ranked.withColumn("target", F.least(cap, F.col("weight") * level))


def packed(docs: DataFrame, text: str, id_col: str, source: str) -> DataFrame:
    """Every row's place: ``src, bucket, nth`` name it, ``start`` and ``size`` are in words of its source."""
    rows = kept(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source).cast("string").alias("source"),
            F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("src"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.col(text)).alias("key"),
        ).withColumn("bucket", F.pmod(F.xxhash64("id", "key"), F.lit(BUCKETS))),
        "sizes",
    )
    inside = Window.partitionBy("src", "bucket").orderBy(F.xxhash64("id", F.lit("order")), "id", "key", "size")
    total = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = total.select("src", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("nth", F.row_number().over(inside)).withColumn("within", F.coalesce(upto, F.lit(0)))
    return kept(
        placed.join(offsets.hint("merge"), ["src", "bucket"]).select(
            "src", "bucket", "nth", "id", "key", "source", "size", (F.col("offset") + F.col("within")).alias("start")
        ),
        "packed",
    )


def shuffled(place: Column, n: Column, *keys: Column) -> Column:
    """A pseudorandom permutation of 0 to ``n - 1``, applied to ``place``."""

    def swap(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*keys, r), n) - x, n)
        odd = F.xxhash64(*keys, r, F.greatest(x, mirror), F.lit("swap")).bitwiseAND(F.lit(1)) == 1
        return F.when(odd, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), place, swap)


def slots(goals: DataFrame, block_words: int, most: int, shards: int, seed: int) -> DataFrame:
    """``src, epoch, slot, shard, block, words``: the first ``words`` of a block go to an output shard."""
    L = F.lit(block_words).cast("long")
    size, wanted = F.col("source_size"), F.round("target").cast("long")
    passes = goals.filter("source_size > 0").select(
        "src", size, F.floor(size / L).alias("full"), F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("epoch"), wanted.alias("wanted")
    )
    passes = passes.withColumn("take", F.least(size, F.col("wanted") - F.col("epoch") * size)).filter("take > 0")
    passes = passes.withColumn("slots", F.ceil(F.col("take") / L))
    parts = passes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / UNFOLDED))))
    # a number of partitions of one's own: adaptive execution would fold the few rows into one task, which unfolds them all
    n_slots = passes.agg(F.sum("slots")).first()[0] or 0
    parts = parts.repartition(max(1, -(-n_slots // SLOTS_A_TASK)), "src", "epoch", "part")
    first = F.col("part") * UNFOLDED
    each = parts.withColumn("slot", F.explode(F.sequence(first, F.least(first + UNFOLDED, F.col("slots")) - 1)))
    keys = F.col("src"), F.col("epoch"), F.lit(seed)
    full = F.col("full")
    return each.select(
        "src", "epoch", "slot",
        F.pmod(F.xxhash64(*keys, "slot", F.lit("shard")), F.lit(shards)).alias("shard"),
        F.when(F.col("slot") < full, shuffled(F.col("slot"), F.greatest(full, F.lit(1)), *keys)).otherwise(full).alias("block"),
        F.least(L, F.col("take") - F.col("slot") * L).alias("words"),
    )


def parts(rows: DataFrame, block_words: int) -> DataFrame:
    """The documents' parts of blocks: words ``at`` to ``at + n`` of a document begin at ``begin`` in ``block``."""
    L = F.lit(block_words).cast("long")
    last = F.floor((F.col("start") + F.col("size") - 1) / L)
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / L), last))
    cut = rows.withColumn("block", F.explode_outer(blocks))
    low = F.greatest(F.col("start"), F.col("block") * L)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * L)
    return cut.select(
        *rows.columns, "block", (low - F.col("start")).alias("at"), (low - F.col("block") * L).alias("begin"), (high - low).alias("n")
    )


def drawn(docs: DataFrame, text: str, id_col: str, source: str, block_words: int, shards: int, seed: int,
          weights: tuple[int, ...], budget: float, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Packed rows, targets and slots."""
    rows = packed(docs, text, id_col, source)
    goals = kept(targets(rows.groupBy("src", "source").agg(F.sum("size").alias("source_size")), weights, budget, most), "targets")
    return rows, goals, slots(goals, block_words, most, shards, seed)


def _taken() -> Column:
    return F.greatest(F.lit(0), F.least(F.col("n"), F.coalesce("words", F.lit(0)) - F.col("begin")))


def mix(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", block_words: int = BLOCK_WORDS,
    shards: int = SHARDS, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST,
) -> DataFrame:
    """One row per row of ``docs``: ``size, source_size, target, taken``, in words."""
    rows, goals, lots = drawn(docs, text, id_col, source, block_words, shards, seed, weights, budget, most)
    met = parts(rows, block_words).join(lots.select("src", "block", "words").hint("merge"), ["src", "block"], "left")
    taken = met.groupBy("src", "bucket", "nth", "id", "size").agg(F.coalesce(F.sum(_taken()), F.lit(0)).alias("taken"))
    return taken.join(goals.select("src", "source_size", "target"), "src").select(
        F.col("id").alias(id_col), "size", "source_size", F.col("target").cast("double").alias("target"), "taken"
    )


def source_counts(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """``shard, source, slots, words``: the multinomial draw of every output shard."""
    settings = {"block_words": BLOCK_WORDS, "shards": SHARDS, "seed": SEED, "weights": WEIGHTS, "budget": BUDGET, "most": MOST}
    _, goals, lots = drawn(docs, text, id_col, source, **settings | options)
    counted = lots.groupBy("shard", "src").agg(F.count(F.lit(1)).alias("slots"), F.sum("words").alias("words"))
    return counted.join(goals.select("src", "source"), "src").select("shard", "source", "slots", "words")


def mixed_documents(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", n_chars: str | None = "n_chars",
    block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET, most: int = MOST,
) -> DataFrame:
    """The documents of which the mix takes words, with the words taken, a pass after the other, as their text.

    Rows that repeat id and text come out once, with the words of all of them.
    """
    rows, _, lots = drawn(docs, text, id_col, source, block_words, shards, seed, weights, budget, most)
    met = parts(rows.filter("size > 0"), block_words).join(lots.select("src", "block", "epoch", "words").hint("merge"), ["src", "block"])
    spans = (
        met.select("id", "key", F.struct("epoch", "nth", "at", _taken().alias("n")).alias("s"))
        .filter("s.n > 0")
        .groupBy("id", "key")
        .agg(F.sort_array(F.collect_list("s")).alias("spans"))
    )
    # The row travels as one column, so that its own names clash with none; texts cross one exchange, by `name`.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("key")).alias("name"), row).dropDuplicates(["name"])
    joined = own.join(spans.select(F.struct("id", "key").alias("name"), "spans").hint("merge"), "name")
    words = F.regexp_extract_all(F.col(f"row.`{text}`"), F.lit(WORD), F.lit(0))
    # `bound`: the text is split once, not once for every span
    taken = bound(
        words, lambda w: F.transform("spans", lambda s: F.array_join(F.slice(w, (s["at"] + 1).cast("int"), s["n"].cast("int")), " "))
    )
    out = joined.select("row", F.array_join(taken, " ").alias("taken"))
    new = {text: F.col("taken")}
    if n_chars is not None and n_chars in docs.columns:
        new[n_chars] = F.length("taken").cast(docs.schema[n_chars].dataType)
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
