"""Groups of texts by an exact Jaccard join of word n-gram sets over prefix trees.

``operators.neardup`` and ``llm.ngram_join`` make their results from it.

A document's set holds the 64-bit fingerprints of its ``n``-word shingles. Equal
sets are one member of the join, whatever the number of their documents.

* **Global order.** Rare shingles come first: the most frequent ones, counted
  over all documents by lossy counting (an undercount of at most one per chunk of
  texts), stand at the end by rising count, the others by fingerprint. The order
  is the same everywhere, so it steers the work and not the result.
* **Where members meet.** Two sets as similar as asked share a shingle among the
  first ``|set| - least overlap + 1`` of each. Members are dealt out by these.
  A shingle of one set only ends there. In each remaining group every member is
  first joined with the group's ends in two orders, then groups that still hold
  several components give the pairs between them: no pair that could link two
  components is left out, and a large group of copies gives four pairs per
  member. Pairs whose sizes, places or parity bits rule a link out are not asked.
* **Prefix tree.** The partners of a probe are stored as a prefix tree over the
  global order: sorted sets with the length each shares with the one before.
  One walk over the tree keeps the overlap along the current path, so shared
  beginnings are counted once; a subtree is left as soon as its overlap plus what
  the probe or the subtree has left can't reach the overlap asked for.

Documents link when ``100 * intersection >= percent * union``. Null or blank
texts have no shingle and link with nothing. Texts below ``n`` words have their
whole sequence as the one shingle. Repeated rows and ids are rows of their own
with the component of their set; a null id counts for no component's number and
gets its component's. Empty table: no rows. Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.words import Texts, chunks, combined, mixed
from weftline.operators.tables import LABEL_BYTES, components, in_batches, kept, sized

#: Most frequent shingles that are put last; bounds what travels with the tasks (16 bytes each).
LAST_SHINGLES = 1 << 17

#: Least number of parity bits of a set; a larger set has about as many as members.
LEAST_BITS = 512

#: Partners of one probe in one prefix tree.
TREE_SETS = 256

_COUNTED_AT_ONCE = 1 << 22

#: Bytes of text in work at once; what stands beside them takes many times as much, and a worker keeps that room.
_TEXT_AT_ONCE = 1 << 19


def _sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The ascending distinct shingles of each text."""
    texts = Texts(column, lower=True)
    start, end, row = texts.words()
    prints = texts.fingerprints(start, end)
    shingles = combined(prints, n)
    first = np.searchsorted(row, np.arange(texts.n + 1))
    for k in range(texts.n):
        a, b = first[k], first[k + 1]
        if b - a >= n:
            yield np.unique(shingles[a : b - n + 1])
        elif b > a:
            yield combined(prints[a:b], int(b - a), seed=1)
        else:
            yield np.zeros(0, np.uint64)


def _name(tokens: np.ndarray) -> int:
    """A 64-bit name of a set: its scrambled members and size."""
    return int(mixed(np.array([mixed(tokens).sum() + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def _parity(sets: list[np.ndarray]) -> pa.Array:
    """Parity bits of each set, 64 to a number: every member turns one over. Their number is a power of two, and the
    halves of a longer row, turned over by each other, are the shorter row."""
    rows = []
    for found in sets:
        size = max(LEAST_BITS, 1 << max(0, len(found) - 1).bit_length())
        odd = (np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)
        rows.append(np.packbits(odd, bitorder="little").view(np.int64))
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def _described(n: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text (kind 0), and a row per shingle that a chunk holds twice or more (kind 1)."""
    several, held = np.empty(_COUNTED_AT_ONCE, np.uint64), 0
    for batch in batches:
        kind = batch.schema.field(0).type
        for part in chunks(batch, "text", _TEXT_AT_ONCE):
            sets = list(_sets(part.column(1), n))
            names = pa.array([_name(s) if len(s) else None for s in sets], pa.int64())
            yield _rows(0, part.column(0), names, [len(s) for s in sets], part.column(2), _parity(sets))
            for found in sets:
                while len(found):
                    piece = found[: len(several) - held]
                    several[held : held + len(piece)] = piece
                    found, held = found[len(piece) :], held + len(piece)
                    if held == len(several):
                        yield _counted(several, kind)
                        held = 0
    if held:
        yield _counted(several[:held], kind)


def _counted(tokens: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    """Sorts ``tokens`` where they stand: there may be many, and few of them twice."""
    tokens.sort()
    again = np.zeros(len(tokens) + 1, bool)  # equal to the one before
    np.equal(tokens[1:], tokens[:-1], out=again[1:-1])
    first = np.flatnonzero(again[1:] & ~again[:-1])
    token, count = tokens[first], np.flatnonzero(again[:-1] & ~again[1:]) - first + 1
    return _rows(1, pa.nulls(len(token), kind), pa.array(token.view(np.int64)), count, pa.nulls(len(token), pa.int64()), pa.nulls(len(token), pa.list_(pa.int64())))


def _rows(kind: int, ids: pa.Array, names: pa.Array, size, key: pa.Array, bits: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), kind, np.int32)), ids, names, pa.array(np.asarray(size, np.int64)), key, bits],
        ["kind", "id", "name", "size", "key", "bits"],
    )


class Order:
    """The global order of shingles: those in ``last`` come after all others, in that sequence."""

    def __init__(self, last: np.ndarray):
        by = np.argsort(last)
        self.known, self.rank = last[by], by  # ascending, and the place of each at the end
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(last & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def is_last(self, tokens: np.ndarray) -> np.ndarray:
        """Which shingles are among those at the end."""
        if not len(self.known):
            return np.zeros(len(tokens), bool)
        return self.known[np.minimum(np.searchsorted(self.known, tokens), len(self.known) - 1)] == tokens

    def arrange(self, tokens: np.ndarray) -> np.ndarray:
        """Ascending distinct shingles in the global order."""
        spots = np.flatnonzero(self.maybe[(tokens & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(spots) or not len(self.known):
            return tokens
        place = np.minimum(np.searchsorted(self.known, tokens[spots]), len(self.known) - 1)
        hit = self.known[place] == tokens[spots]
        spots, place = spots[hit], place[hit]
        late = np.zeros(len(tokens), bool)
        late[spots] = True
        return np.concatenate([tokens[~late], tokens[spots][np.argsort(self.rank[place])]])


@lru_cache(1)  # a worker outlives the run: the next one has an order of its own
def _order(last: bytes) -> Order:
    return Order(np.frombuffer(last, np.uint64))


def least_overlap(a: int, b: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The smallest intersection with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def _prefixes(n: int, percent: int, last, often: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frequent (``often``) or the other shingles of each set's prefix, with their place in the set."""
    order = _order(last.value)
    for batch in batches:
        for part in chunks(batch, "text", _TEXT_AT_ONCE):
            tokens, names, sizes, places = [], [], [], []
            for found in _sets(part.column(0), n):
                size = len(found)
                if size and -(-percent * (size + 1) // 100) <= size:  # else only equal sets can link
                    head = order.arrange(found)[: size - -(-percent * size // 100) + 1]
                    place = np.flatnonzero(order.is_last(head) == often)
                    tokens.append(head[place])
                    names.append(np.full(len(place), _name(found), np.int64))
                    sizes.append(np.full(len(place), size, np.int32))
                    places.append(place.astype(np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), *(pa.array(np.concatenate(c)) for c in (names, sizes, places))],
                    ["token", "name", "size", "place"],
                )


def tree_join(probe: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of ``sets`` link with ``probe``; all hold fingerprints in one global order.

    The sorted sets with the length that each shares with the one before are the
    tree. ``upto`` and ``last_at`` hold, for every node of the current path, the
    overlap so far and the place in the probe behind its last shared shingle.
    """
    where = np.argsort(probe)
    known = probe[where]
    keys = [s.tobytes() for s in sets]  # any order of sequences puts those with one beginning together
    order = sorted(range(len(sets)), key=keys.__getitem__)
    out = np.zeros(len(sets), bool)
    path, upto, last_at = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    for k in order:
        s = sets[k]
        need = int(least_overlap(len(probe), len(s), percent))
        both = min(len(path), len(s))
        differ = np.flatnonzero(path[:both] != s[:both])
        shared = int(differ[0]) if len(differ) else both
        shared = min(shared, len(upto) - 1)
        overlap, passed = int(upto[shared]), int(last_at[shared])
        counts, places, at = [upto[: shared + 1]], [last_at[: shared + 1]], shared
        while True:
            if overlap + min(len(s) - at, len(probe) - passed) < need:
                break
            if at == len(s):
                out[k] = True
                break
            piece = s[at : at + 64]
            spot = np.minimum(np.searchsorted(known, piece), len(known) - 1)
            hit = known[spot] == piece
            grown = overlap + np.cumsum(hit)
            reached = np.maximum.accumulate(np.where(hit, where[spot] + 1, passed))
            reached = np.maximum(reached, passed)
            counts.append(grown)
            places.append(reached)
            overlap, passed, at = int(grown[-1]), int(reached[-1]), at + len(piece)
        path, upto, last_at = s, np.concatenate(counts), np.concatenate(places)
    return out


def _trees(n: int, percent: int, last, group: pa.Table) -> pa.Table:
    """One probe and a block of its partners; the probe's row has no partner. Rows that repeat id and text come several times."""
    order = _order(last.value)
    probe, partners, names, seen = None, [], [], set()
    for batch in group.to_batches():
        for part in chunks(batch, "text", _TEXT_AT_ONCE):
            rows = zip(part.column("role").to_pylist(), part.column("b").to_pylist(), _sets(part.column("text"), n), strict=True)
            for role, name, found in rows:
                if role == 0:
                    probe = order.arrange(found)
                elif name not in seen:
                    seen.add(name)
                    partners.append(order.arrange(found))
                    names.append(name)
    a = group.column("a")[0].as_py()
    good = tree_join(probe, partners, percent)
    return pa.table({"a": pa.array([a] * len(names), pa.int64()), "b": pa.array(names, pa.int64()), "links": pa.array(good)})


def _verified(pairs: DataFrame, docs: DataFrame, looks: DataFrame, trees) -> DataFrame:
    """``a, b, links`` for every pair of set names; ``looks`` has the ``key`` and ``id`` of one text of each.

    That text travels to the trees that ask for it; compressed, it is less than
    half as long as its fingerprints, which are taken again there.
    """
    pairs = kept(pairs, "pairs")
    n = pairs.count()
    degree = pairs.groupBy("a").count().select("a", F.ceil(F.col("count") / TREE_SETS).alias("blocks"))
    block = F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block")
    partners = pairs.join(sized(degree, 32, n), "a").select(F.col("b").alias("name"), F.struct("a", block, "b", F.lit(1).alias("role")).alias("ask"))
    probes = degree.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")).select(
        F.col("a").alias("name"), F.struct("a", "block", F.lit(0).cast("long").alias("b"), F.lit(0).alias("role")).alias("ask")
    )
    asks = partners.union(probes).groupBy("name").agg(F.collect_list("ask").alias("asks"))
    held = kept(looks.select("name", "key", "id").join(sized(asks, 80, 2 * n), "name").select("key", "id", "asks"), "asks")
    bulk = held.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("asks")), F.lit(0))).first()[0]
    w = sized(held, 40, bulk).alias("w")
    texts = docs.alias("d").join(w, (F.col("d.key") == F.col("w.key")) & F.col("d.id").eqNullSafe(F.col("w.id")))
    shipped = texts.select("d.text", F.explode("w.asks").alias("ask")).select("ask.a", "ask.block", "ask.b", "ask.role", "text")
    return kept(in_batches(shipped).groupBy("a", "block").applyInArrow(trees, "a long, b long, links boolean"), "verified")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose sides are not yet in one component."""
    n = comps.count()
    ca, cb = (sized(comps.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}")), LABEL_BYTES, n) for c in "ab")
    both = pairs.join(ca, "a", "left").join(cb, "b", "left")
    return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _differences(percent: int, a: Column, b: Column) -> Column:
    """The largest symmetric difference with which sets of these sizes link."""
    return a + b - 2 * F.ceil((a + b) * percent / (100 + percent))


def _may_link(percent: int, a: str, b: str) -> Column:
    """Sizes and parity bits allow it: no two sets differ in fewer members than in bits."""
    x, y, xs, ys = (F.col(f"{side}{c}") for c in ("size", "bits") for side in (a, b))
    turned = lambda p, q: F.zip_with(p, q, lambda m, n: m.bitwiseXOR(n))
    # Sizes that fit are less than twice each other, so one row of bits is folded once at most.
    half = lambda z: (F.size(z) / 2).cast("int")
    folded = lambda z: turned(F.slice(z, F.lit(1), half(z)), F.slice(z, half(z) + 1, half(z)))
    p = F.when(F.size(xs) > F.size(ys), folded(xs)).otherwise(xs)
    q = F.when(F.size(ys) > F.size(xs), folded(ys)).otherwise(ys)
    odd = F.aggregate(turned(p, q), F.lit(0), lambda acc, w: acc + F.bit_count(w))
    fits = F.greatest(x, y) * percent <= F.least(x, y) * 100
    return F.when(fits, odd <= _differences(percent, x, y)).otherwise(F.lit(False))


#: A group of up to so many members is settled by its ends in one order: they cover all its pairs.
COVERED = 3

_SEEN = ("name", "size", "place")


def _ends() -> dict[str, Column]:
    """The ends of a group in two orders, and its number of rows."""
    plain, other = F.struct(*_SEEN), F.struct(F.xxhash64("name").alias("h"), *_SEEN)
    return {"p0": F.min(plain), "p1": F.max(plain), "p2": F.min(other), "p3": F.max(other), "members": F.count(F.lit(1))}


def _asking(live: DataFrame, percent: int) -> DataFrame:
    """``asks``: the group's ends that a member could link with by sizes and places; ``open``: the ends leave pairs uncovered.

    At a shared shingle, two sets differ at least by how much more one holds
    before it and by how much more one holds behind it.
    """
    two = [F.struct(*[F.col(f"{p}.{c}") for c in _SEEN]) for p in ("p2", "p3")]

    def near(e: Column) -> Column:
        behind = (F.col("size") - F.col("place")) - (e["size"] - e["place"])
        apart = F.abs(F.col("place") - e["place"]) + F.abs(behind)
        return (e["name"] != F.col("name")) & (apart <= _differences(percent, F.col("size"), e["size"]))

    asks = F.transform(F.filter(F.array_distinct(F.array("p0", "p1", *two)), near), lambda e: e["name"])
    several = live.filter("p0.name < p1.name")
    return several.select("token", *_SEEN, asks.alias("asks"), (F.col("members") > COVERED).alias("open"))


def _shared(docs: DataFrame, prefixes, percent: int) -> DataFrame:
    """``token, name, size, place, asks, open`` of the prefix shingles that two sets or more have.

    Shingles outside the frequent ones have bounded groups: one exchange by
    shingle and a window that finds their ends too. Groups of frequent ones may
    hold any share of all rows: their ends are merged before the shuffle and
    joined back, where Spark splits hot keys.
    """
    rare, frequent = (
        in_batches(docs.select("text")).mapInArrow(partial(prefixes, often), "token long, name long, size int, place int") for often in (False, True)
    )
    group = Window.partitionBy("token")
    rare = rare.repartition("token")  # before the window makes the rows wider
    # Most shingles end alone: they go before the ends are looked for, in the order that stands already.
    rare = rare.withColumns({"lo": F.min("name").over(group), "hi": F.max("name").over(group)}).filter("lo < hi").drop("lo", "hi")
    rare = _asking(rare.withColumns({k: c.over(group) for k, c in _ends().items()}), percent).dropDuplicates(["token", "name"])
    ends = frequent.groupBy("token").agg(*[c.alias(k) for k, c in _ends().items()]).filter("p0.name < p1.name")
    return rare.union(_asking(frequent.join(ends.hint("merge"), "token"), percent).dropDuplicates(["token", "name"]))


def _most_frequent(counted: DataFrame, most: int) -> bytes:
    """At most ``most`` shingles by count, rarest first; a count is taken with all its shingles or not at all."""
    step = F.floor(8 * F.log2("n"))
    left, floor = most, None
    steps = counted.groupBy(step.alias("step")).count().collect()  # some hundred rows
    for row in sorted(steps, key=lambda r: -r["step"]):
        left -= row["count"]
        if left < 0:
            break
        floor = row["step"]
    if floor is None:
        return b""
    rows = counted.filter(step >= floor).select("n", "token").toPandas().sort_values(["n", "token"])
    return rows["token"].to_numpy(np.int64).tobytes()


def grouped(
    docs: DataFrame, text: str, id_col: str, n: int, percent: int, last_shingles: int = LAST_SHINGLES
) -> tuple[DataFrame, DataFrame]:
    """Each row's ``id``, text ``key``, set's ``name`` and ``size``; and ``node, comp`` of the sets that link with another."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    described = kept(
        in_batches(docs).mapInArrow(partial(_described, n), f"kind int, id {kind}, name long, size long, key long, bits array<long>"), "described"
    )
    rows = described.filter("kind = 0").drop("kind")
    counted = described.filter("kind = 1").groupBy(F.col("name").alias("token")).agg(F.sum("size").alias("n"))
    last = spark.sparkContext.broadcast(_most_frequent(kept(counted, "counted"), last_shingles))

    live = kept(_shared(docs, partial(_prefixes, n, percent, last), percent), "live")
    one_each = kept(rows.filter("size > 0").dropDuplicates(["name"]), "looks")
    looks = one_each.select("name", "size", "bits")
    stars = live.select(F.explode("asks").alias("a"), F.col("name").alias("b")).distinct()
    stars = kept(stars.join(looks.select(*[F.col(c).alias(f"a_{c}") for c in looks.columns]), F.col("a") == F.col("a_name")), "stars")
    stars = kept(
        stars.join(looks.withColumnRenamed("name", "b"), "b").filter(_may_link(percent, "a_", "")).select("a", "b"), "stars"
    )

    def trees(group: pa.Table) -> pa.Table:
        return _trees(n, percent, last, group)

    # one end for each member first, the others only where that left two components
    tried = _verified(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), docs, one_each, trees)
    comps = components(tried.filter("links"))
    tried = tried.union(_verified(_apart(stars, comps).join(tried, ["a", "b"], "left_anti"), docs, one_each, trees))
    comps = components(tried.filter("links"), start=comps)

    members = live.filter("open").join(sized(comps.withColumnRenamed("node", "name"), LABEL_BYTES), "name", "left")
    members = kept(members.select("token", "name", "place", F.coalesce("comp", "name").alias("comp")), "members")
    mixed_groups = members.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("token")
    open_ = kept(members.join(mixed_groups, "token", "left_semi").join(looks, "name"), "open")
    x = open_.select("token", *[F.col(c).alias(f"x_{c}") for c in open_.columns if c != "token"])
    y = open_.select("token", *[F.col(c).alias(f"y_{c}") for c in open_.columns if c != "token"])
    # at their first shared shingle all that stand before it differ
    first = F.col("x_place") + F.col("y_place") <= _differences(percent, F.col("x_size"), F.col("y_size"))
    rest = (
        x.join(y, "token").filter((F.col("x_comp") < F.col("y_comp")) & first & _may_link(percent, "x_", "y_"))
        .select(F.col("x_name").alias("a"), F.col("y_name").alias("b")).distinct()
    )
    done = tried.select("a", "b").union(tried.select("b", "a"))
    rest = kept(rest.join(sized(done, LABEL_BYTES), ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = _verified(rest, docs, one_each, trees)
        comps = components(tried.filter("links").union(more.filter("links")), start=comps)

    return rows, comps
