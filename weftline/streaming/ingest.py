"""Incremental ingest of landed files into a keyed table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weftline.operators.dedupe import latest_by_key
from weftline.sinks.publish import publish

_BROKEN = "_broken"


def ingest(
    spark: SparkSession,
    landing: str,
    schema: str | T.StructType,
    target: str,
    id_col: str,
    checkpoint: str,
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    mode: str = "append",
    order_by: list[str] | None = None,
    max_files: int | None = None,
    pattern: str | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Take in all files landed since the last run, then stop; run it once a day.

    The checkpoint remembers the files taken. A batch that is repeated after a
    failure overwrites itself in the keyed table, and ids published before are
    not added again, so re-runs change nothing and late rows are taken like any
    others. An id that comes twice in one batch is published once, by ``order_by`` (all columns if not given).

    Rows that cannot be published do not stop the job: lines that do not parse
    (JSON and CSV) and rows whose id is null go to ``rejects`` (``<target>-rejects``
    if not given) with a reason and the number of their batch; see ``read_rejects``.
    A repeated batch overwrites its rejects too. ``transform`` is applied to the
    parsed rows of each batch.
    """
    rejects = rejects or f"{target.rstrip('/')}-rejects"
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = fmt in ("json", "csv")
    full = T.StructType([*declared.fields, T.StructField(_BROKEN, T.StringType())]) if parsed else declared
    reader = spark.readStream.format(fmt).schema(full)
    if parsed:
        reader = reader.option("columnNameOfCorruptRecord", _BROKEN).option("mode", "PERMISSIVE")
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)

    def write(batch: DataFrame, number: int) -> None:
        good, bad = batch, []
        if parsed:
            # All columns are named, as Spark reads none of a raw file for the broken text alone.
            text = F.coalesce(F.col(_BROKEN), F.to_json(F.struct(*declared.names)))
            bad.append(batch.filter(F.col(_BROKEN).isNotNull()).select(text.alias("row"), F.lit("does not parse").alias("reason")))
            good = batch.filter(F.col(_BROKEN).isNull()).drop(_BROKEN)
        if transform is not None:
            good = transform(good)
        bad.append(good.filter(F.col(id_col).isNull()).select(F.to_json(F.struct("*")).alias("row"), F.lit("no id").alias("reason")))
        good = good.filter(F.col(id_col).isNotNull())
        order = order_by or [c for c in good.columns if c != id_col]
        publish(latest_by_key(good, id_col, order), target, id_col, mode, number)
        reduce(DataFrame.unionByName, bad).write.mode("overwrite").parquet(f"{rejects}/batch={number}")

    return (
        reader.load(landing)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``row, reason, batch`` of all rows that were not published."""
    return spark.read.schema("row string, reason string, batch int").parquet(path)
