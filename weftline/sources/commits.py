"""Commit logs: one ``hash;author;email;date;message`` line per commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.dates import commit_day, commit_instant


def parse_commits(lines: DataFrame, line_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected lines with the reason.

    The message keeps its own semicolons. Other columns (such as the repository)
    pass through, so logs of many repositories parse in one job.
    """
    rest = [c for c in lines.columns if c != line_col]
    fields = F.split(line_col, ";", 5)
    parsed = lines.select(
        *rest,
        F.col(line_col).alias("line"),
        F.size(fields).alias("n_fields"),
        *[
            F.try_element_at(fields, F.lit(i)).alias(name)
            for i, name in enumerate(("hash", "author", "email", "when", "message"), start=1)
        ],
    ).withColumn("day", commit_day(F.col("when")))
    reason = F.when(F.col("n_fields") < 5, "missing fields").when(F.col("day").isNull(), "bad date")
    judged = parsed.withColumn("reason", reason)
    good = judged.filter("reason IS NULL").select(
        *rest,
        "hash",
        "author",
        "email",
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        "message",
        commit_instant(F.col("when")).alias("committed_at"),
    )
    rejects = judged.filter("reason IS NOT NULL").select(*rest, "line", "reason")
    return good, rejects


def read_commit_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Logs written as Latin-1, one file per repository; the file stem names the repository."""
    raw = spark.read.text(path)
    lines = raw.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("repo"),
        F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("value"),
    )
    return parse_commits(lines)
