"""Text files as records that know their place: ``file``, ``block`` (its first byte) and ``row`` in the block.

Files are split as Spark splits text, so one file is read by many tasks. Records
that may hold line ends in quotes need the quote state at the head of their block,
which no task knows. So a first pass reports for every block how it would end from
either state; these reports, one row a block, are composed in file order; and the
second pass reads every block from its true state. Parts of a record that crosses
blocks are joined by their place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.operators.skew import is_small

#: Blocks that begin inside quotes are sent to all tasks, up to this number; files with more are not split.
MAX_OPEN_BLOCKS = 200_000

SOURCE = ("file", "block", "row")


def _lines(spark: SparkSession, path: str, separator: str) -> DataFrame:
    lines = spark.read.option("lineSep", separator).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The runs of a batch that come from one block."""
    files, block = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    code = files.indices.to_numpy()
    edges = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (block[1:] != block[:-1]))) if len(code) else []
    for a, b in zip(edges, [*edges[1:], len(code)], strict=True):
        yield files.dictionary[int(code[a])].as_py(), int(block[a]), batch.slice(int(a), int(b - a))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, row = None, 0
    for batch in batches:
        for file, block, run in _blocks(batch):
            row = row if at == (file, block) else 0
            at = file, block
            rows = pa.array(np.arange(row, row + run.num_rows))
            row += run.num_rows
            yield pa.RecordBatch.from_arrays([run.column(0), run.column(1), rows, run.column(2)], [*SOURCE, "value"])


def numbered_lines(spark: SparkSession, path: str, separator: str = "\n") -> DataFrame:
    """``file, block, row, value``: the lines of all files, with their place."""
    return _lines(spark, path, separator).mapInArrow(_numbered, "file string, block long, row long, value string")


def source_ids(df: DataFrame, out: str = "id", start: int = 0) -> DataFrame:
    """Number rows without gaps in source order: files by name, then blocks, then rows.

    ``df`` holds every row of its blocks. Only one count a block is summed up; no
    row is sorted or moved. ``file``, ``block`` and ``row`` stay.
    """
    counts = df.groupBy("file", "block").agg((F.max("row") + 1).alias("_n"))
    # One row per block of the files.
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    side = F.broadcast(offsets) if is_small(offsets, 100_000) else offsets
    return df.join(side, ["file", "block"]).withColumn(out, F.col("row") + F.col("_before") + F.lit(start)).drop("_before")


# Records with line ends in quotes -------------------------------------------------


def ends_inside(line: str, inside: bool, delimiter: str = ",", quote: str = '"') -> bool:
    """Whether a quoted field is open behind a line. A quote opens a field only at its head; two in a row are a character."""
    at = 0
    if not inside:
        if line.startswith(quote):
            inside, at = True, 1
    while True:
        if inside:
            at = line.find(quote, at)
            if at < 0:
                return True
            if line.startswith(quote, at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        at = line.find(delimiter + quote, at)
        if at < 0:
            return False
        inside, at = True, at + len(delimiter) + 1


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every block, the state behind it if it began outside quotes, and if inside."""
    at, state = None, [False, True]
    names = ["file", "block", "from_out", "from_in"]

    def report() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]]), pa.array([state[0]]), pa.array([state[1]])], names)

    for batch in batches:
        for file, block, run in _blocks(batch):
            if at != (file, block):
                if at is not None:
                    yield report()
                at, state = (file, block), [False, True]
            quoted = run.column(2).filter(pc.match_substring(run.column(2), '"'))  # no other line changes the state
            for line in quoted.to_pylist():
                state = [ends_inside(line, s) for s in state]
    if at is not None:
        yield report()


def open_blocks(lines: DataFrame) -> DataFrame:
    """``file, block`` of the blocks that begin inside quotes.

    A block that ends alike from both states settles the state behind it; of those
    since then, each one that turns the state over counts once.
    """
    reports = lines.mapInArrow(_reports, "file string, block long, from_out boolean, from_in boolean")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    settled = F.col("from_out") == F.col("from_in")
    turns = F.sum(F.when(F.col("from_out") & ~F.col("from_in"), 1).otherwise(0))
    upto = reports.withColumn("turns", turns.over(Window.partitionBy("file").orderBy("block")))
    known = F.last(F.when(settled, F.struct("from_out", "turns")), ignorenulls=True).over(earlier)
    state = upto.withColumns({"known": known, "before": F.coalesce(F.last("turns").over(earlier), F.lit(0))})
    odd = (F.col("before") - F.coalesce("known.turns", F.lit(0))) % 2 == 1
    return state.filter(F.coalesce("known.from_out", F.lit(False)) != odd).select("file", "block")


#: What a piece of text is: a record, or the head, the middle or the end of one that crosses blocks.
WHOLE, HEAD, MIDDLE, END = range(4)


def _records(opened: frozenset, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, row, inside, part, held = None, 0, False, WHOLE, []
    out: list[tuple] = []

    def close(kind: int) -> None:
        nonlocal row, held
        text = "\n".join(held)
        out.append((*at, row if kind in (WHOLE, HEAD) else -1, kind, text[:-1] if kind in (WHOLE, END) and text.endswith("\r") else text))
        row += kind in (WHOLE, HEAD)
        held = []

    def end_block() -> None:
        if held:
            close(HEAD if part == WHOLE else MIDDLE)

    def flush() -> pa.RecordBatch:
        nonlocal out
        columns, out = list(zip(*out, strict=True)) if out else [()] * 5, []
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [*SOURCE, "part", "text"])

    for batch in batches:
        for file, block, run in _blocks(batch):
            if at != (file, block):
                end_block()
                at, row, inside = (file, block), 0, (file, block) in opened
                part = END if inside else WHOLE
            for line in run.column(2).to_pylist():
                held.append(line)
                if '"' in line:
                    inside = ends_inside(line, inside)
                if not inside:
                    close(part)
                    part = WHOLE
        yield flush()
    end_block()
    yield flush()


def quoted_records(spark: SparkSession, path: str) -> DataFrame | None:
    """``file, block, row, text``: records whose quoted fields may hold line ends; null if too many blocks begin inside quotes.

    The place is that of a record's first line. Line ends inside a record stay; a
    carriage return at its end does not.
    """
    lines = _lines(spark, path, "\n")
    opened = open_blocks(lines).limit(MAX_OPEN_BLOCKS + 1).collect()
    if len(opened) > MAX_OPEN_BLOCKS:
        return None
    job = partial(_records, frozenset((r["file"], r["block"]) for r in opened))
    records = lines.mapInArrow(job, "file string, block long, row long, part int, text string")
    whole = records.filter(F.col("part") == WHOLE).select(*SOURCE, "text")
    if not opened:
        return whole
    # The end of one record comes before the head of the next in a block.
    order = Window.partitionBy("file").orderBy("block", F.col("part") == HEAD)
    parts = records.filter(F.col("part") != WHOLE).withColumn("nth", F.sum((F.col("part") == HEAD).cast("int")).over(order))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"])
    # As many pieces as one record has blocks.
    joined = parts.groupBy("file", "nth").agg(
        F.min("block").alias("block"), F.max("row").alias("row"), F.array_join(pieces, "\n").alias("text")
    )
    return whole.unionByName(joined.select(*SOURCE, "text"))
