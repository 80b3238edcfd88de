"""The keyed table: rows under a unique id, fed batch by batch.

Every publish writes one new folder, split into a fixed number of buckets by a hash
of the id; nothing that readers see is changed in place. A small pointer file then
names the folders of each bucket that are live. An id stands in one live folder
only: an upsert rewrites the buckets that hold ids of the batch, without these, and
leaves the others as they are. So a read is a plain scan without a shuffle, and a
job that dies before the pointer is written leaves the table as it was. There is no
lock: one writer per table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.ids import bad_ids
from weftline.storage import hadoop_folder

#: Buckets of a new table. An upsert rewrites whole buckets, so a large table wants some hundred.
BUCKETS = 8
_BUCKET = "bucket"


def _pointers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the pointer files."""
    root, fs = hadoop_folder(spark, f"{path}/_live")
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _pointer(spark: SparkSession, path: str, number: int) -> dict:
    """``batch``, ``schema``, ``buckets``, ``before`` (the pointer that the batch was applied to) and ``live``: each bucket's folders."""
    file, _ = hadoop_folder(spark, f"{path}/_live/{number}.json")
    return json.loads(spark.read.text(file.toString(), wholetext=True).first()[0])


def _point(spark: SparkSession, path: str, number: int, state: dict) -> None:
    """Write the pointer under another name and put it in place, which is what readers go by."""
    file, fs = hadoop_folder(spark, f"{path}/_live/{number}.json")
    draft, _ = hadoop_folder(spark, f"{path}/_live/_{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(json.dumps(state).encode())
    out.close()
    if not fs.rename(draft, file):
        raise OSError(f"pointer {number} of {path} is there already: another writer?")


def _bucket(id_col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string")), F.lit(buckets)).cast("int").alias(_BUCKET)


def _write(df: DataFrame, path: str, id_col: str, buckets: int) -> tuple[str, list[int]]:
    """Write rows to a new folder; its name and the buckets it has. Rebalancing splits large buckets and joins small ones."""
    folder = f"rows-{uuid.uuid4().hex}"
    spread = df.withColumn(_BUCKET, _bucket(id_col, buckets)).hint("rebalance", _BUCKET)
    spread.write.partitionBy(_BUCKET).parquet(f"{path}/{folder}")
    root, fs = hadoop_folder(df.sparkSession, f"{path}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return folder, sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{_BUCKET}="))


def _read(spark: SparkSession, path: str, live: dict[str, list[str]], buckets: list[int] | None = None) -> DataFrame | None:
    """The rows of some live buckets; a column that a folder lacks is null there."""
    folders = [f"{path}/{f}/{_BUCKET}={b}" for b, names in live.items() if buckets is None or int(b) in buckets for f in names]
    return spark.read.option("mergeSchema", True).parquet(*folders) if folders else None


def publish(
    df: DataFrame, path: str, id_col: str, mode: str = "append", batch: int | None = None, buckets: int = BUCKETS
) -> None:
    """Write ``df`` under its unique id.

    ``append`` adds ids that are new and leaves others as they are, ``upsert``
    also replaces rows with known ids, ``replace`` starts the table anew.
    ``batch`` is the number to write under, by default the next one; if it is that
    of the last publish, that one is taken back first. The rows are computed once;
    null or repeated ids are refused before anything becomes visible. ``buckets``
    counts for a table's first publish and for ``replace``.
    """
    spark = df.sparkSession
    if mode not in ("append", "upsert", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    if _BUCKET in df.columns:
        raise ValueError(f"a column cannot be named {_BUCKET}")
    known = _pointers(spark, path)
    last = _pointer(spark, path, known[-1]) if known else {"batch": -1, "before": None, "live": {}, "buckets": buckets}
    buckets = buckets if mode == "replace" else last["buckets"]
    number = batch if batch is not None else last["batch"] + 1
    base, before = last["live"], known[-1] if known else None
    if known and number == last["batch"]:  # a repeated batch replaces itself
        before = last["before"]
        base = _pointer(spark, path, before)["live"] if before is not None else {}
    new, touched = _write(df, path, id_col, buckets)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(f"{path}/{new}")
    wrong = bad_ids(rows, id_col).limit(5).collect()
    if wrong:
        _drop(spark, f"{path}/{new}")
        raise ValueError(f"null or repeated ids, such as {[r[id_col] for r in wrong]}")
    live = {b: list(names) for b, names in base.items()} if mode != "replace" else {}
    held = _read(spark, path, live, touched)
    shared: list[int] = []
    if held is not None:  # the buckets that share ids, a bounded number
        both = rows.join(held.select(id_col), id_col, "left_semi").select(_BUCKET).distinct()
        shared = [r[0] for r in both.collect()]
    if shared and mode == "append":
        fresh, touched = _write(rows.drop(_BUCKET).join(held.select(id_col), id_col, "left_anti"), path, id_col, buckets)
        _drop(spark, f"{path}/{new}")
        new = fresh
    elif shared:
        rest, left = _write(_read(spark, path, live, shared).join(rows.select(id_col), id_col, "left_anti"), path, id_col, buckets)
        for b in shared:
            live[str(b)] = [rest] if b in left else []
    for b in touched:
        live.setdefault(str(b), []).append(new)
    _point(spark, path, known[-1] + 1 if known else 0, {"batch": number, "before": before, "live": live, "buckets": buckets, "schema": df.schema.jsonValue()})
    _sweep(spark, path)


def _drop(spark: SparkSession, path: str) -> None:
    folder, fs = hadoop_folder(spark, path)
    fs.delete(folder, True)


def _sweep(spark: SparkSession, path: str) -> None:
    """Delete folders that neither the last pointer nor the one it was applied to names, and older pointers.

    Readers that began on the state before the last one can still end.
    """
    known = _pointers(spark, path)
    keep = {known[-1], *known[-2:-1], _pointer(spark, path, known[-1])["before"]} - {None}
    named = {f for n in keep for names in _pointer(spark, path, n)["live"].values() for f in names}
    root, fs = hadoop_folder(spark, path)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("rows-") and name not in named:
            fs.delete(status.getPath(), True)
    for n in set(known) - keep:
        fs.delete(hadoop_folder(spark, f"{path}/_live/{n}.json")[0], False)


def read_published(spark: SparkSession, path: str, id_col: str | None = None) -> DataFrame:
    """The table with one row per id; a column that a batch lacks is null there. A plain scan: ids stand in one place."""
    known = _pointers(spark, path)
    if not known:
        raise FileNotFoundError(f"no published table in {path}")
    state = _pointer(spark, path, known[-1])
    found = _read(spark, path, state["live"])
    return found if found is not None else spark.createDataFrame([], T.StructType.fromJson(state["schema"]))


def compact(spark: SparkSession, path: str, target: str, id_col: str) -> None:
    """Write the table with its batches folded into one to a new ``target`` folder."""
    publish(read_published(spark, path), target, id_col, mode="replace")
