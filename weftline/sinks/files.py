"""File sinks: CSV, JSON lines, compressed parquet, one dataset per class, a text file per row."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.storage import hadoop_folder

#: What Spark escapes in the name of a partition's folder, and the name for null and the empty string (fixed values).
_ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^")]}
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

#: Tasks for each core that make the files of rows; a table may come as one task.
TASKS_A_CORE = 4


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """UTF-8 CSV with a header and a fixed column order."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_parquet(df: DataFrame, path: str, level: int = 9) -> None:
    """Parquet with strong zstd compression; every row is written, whatever the batch size."""
    (
        df.write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", str(level))
        .parquet(path)
    )


def write_per_class(df: DataFrame, path: str, class_col: str) -> None:
    """One folder per class. Rows are not regrouped first, so a large class keeps many tasks."""
    df.write.mode("overwrite").partitionBy(class_col).parquet(path)


def _write_each(top: str, folders: Sequence[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One file for each row (folder values, text); a file stands there whole or not at all, and a repeated task replaces its own."""
    task = TaskContext.get()
    made, n = set(), 0
    for batch in batches:
        for *values, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            folder = "/".join([top, *(f"{name}={value.translate(_ESCAPED) if value else _NO_VALUE}" for name, value in zip(folders, values, strict=True))])
            if folder not in made:
                os.makedirs(folder, exist_ok=True)
                made.add(folder)
            name = f"part-{task.partitionId():05}-{n:08}.txt"
            held = f"{folder}/.{name}.{task.taskAttemptId()}"  # readers pass over hidden files
            with open(held, "wb") as out:
                out.write(f"{text or ''}\n".encode())
            os.replace(held, f"{folder}/{name}")
            n += 1
    yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})


def write_text_per_row(df: DataFrame, path: str, value: str, folders: Sequence[str]) -> None:
    """A text file for each row, below folders as ``partitionBy`` names them; a null text gives an empty line.

    Hadoop without its native library starts two processes for each file it makes in
    a local folder, about 16 ms. There the tasks make the files; any other
    store gets them from Spark's writer. ``path`` is new and is read only after all is written.
    """
    rows = df.select(*(F.col(c).cast("string").alias(c) for c in [*folders, value]))
    whole, fs = hadoop_folder(df.sparkSession, path)
    if fs.getUri().getScheme() == "file":
        fs.mkdirs(whole)  # a table without rows is an empty folder
        top = fs.makeQualified(whole).toUri().getPath()
        dealt = rows.repartition(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)
        dealt.mapInArrow(partial(_write_each, top, list(folders)), "n long").agg(F.sum("n")).collect()
    else:  # tasks put their files into place, not the driver one after another
        placed = rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
        placed.partitionBy(*folders).option("maxRecordsPerFile", 1).text(path)


def to_driver(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 256 << 20) -> pa.Table:
    """A small result as an Arrow table; a larger one, by rows or bytes, is refused, not cut.

    It is computed once: a row more than allowed is asked for and tells.
    """
    found = df.limit(max_rows + 1).toArrow()
    if found.num_rows > max_rows:
        raise ValueError(f"result has more than {max_rows} rows: write it instead")
    if found.nbytes > max_bytes:
        raise ValueError(f"result has {found.nbytes} bytes: write it instead")
    return found
