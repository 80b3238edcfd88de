"""Plain file sources. Every reader takes a declared schema; none infers one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.dates import day_before
from weftline.sources.lines import SOURCE, numbered_lines, quoted_records

#: The column in which Spark's parsers leave what they cannot read.
BROKEN = "_broken"


def _kinds(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _ddl(fields: list[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _by_name(rows: DataFrame, wanted: T.StructType, *more: str) -> DataFrame:
    return rows.select(
        *more, *[F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted]
    )


def _header(spark: SparkSession, path: str, wanted: T.StructType) -> list[T.StructField]:
    """The columns that the files have; those the schema lacks are read as text."""
    names = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns
    kinds = {f.name: f.dataType for f in wanted}
    return [T.StructField(name, kinds.get(name, T.StringType())) for name in names]


def _csv_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> tuple[T.StructType, DataFrame] | None:
    """Records with their place, ``text``, the parsed ``row_`` and, in it, what could not be parsed."""
    wanted = _kinds(schema)
    records = quoted_records(spark, path)
    if records is None:
        return None
    header = _header(spark, path, wanted)
    kind = _ddl([*header, T.StructField(BROKEN, T.StringType())])
    parsed = F.from_csv("text", kind, {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    rows = records.filter(~((F.col("block") == 0) & (F.col("row") == 0)) & (F.col("text") != ""))
    return wanted, rows.select(*SOURCE, "text", parsed.alias("row_"))


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, source: bool = False) -> DataFrame:
    """CSV with a header line; quoted fields may hold commas, quotes and line ends, and files are split all the same.

    Columns are matched by the header's names, which all files share: one that
    the files lack is null, one that the schema lacks is left out. ``source`` adds
    ``file, block, row``, the place of each record; see ``lines.source_ids``. A
    record that does not fit gives what could be read of it; ``read_csv_checked``
    sets it apart.
    """
    found = _csv_rows(spark, path, schema)
    if found is None:  # quotes stand open over most of the files: one task a file
        wanted = _kinds(schema)
        header = T.StructType(_header(spark, path, wanted))
        if source:
            raise ValueError("too many blocks begin inside quotes to place the records")
        return _by_name(spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(header).csv(path), wanted)
    wanted, rows = found
    return _by_name(rows.select(*SOURCE, "row_.*"), wanted, *(SOURCE if source else ()))


def read_csv_checked(spark: SparkSession, path: str, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows with their place, and rejects: ``file, block, row, reason, text``.

    A record is rejected if it has more or fewer fields than the header or a value
    that is not of its declared type.
    """
    found = _csv_rows(spark, path, schema)
    if found is None:
        raise ValueError("too many blocks begin inside quotes to place the records")
    wanted, rows = found
    broken = F.col(f"row_.{BROKEN}").isNotNull()
    good = _by_name(rows.filter(~broken).select(*SOURCE, "row_.*"), wanted, *SOURCE)
    return good, rows.filter(broken).select(*SOURCE, F.lit("not a row of the declared columns").alias("reason"), "text")


def read_json_array(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Files that each hold one JSON array (or one object)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def _json_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    kind = _ddl([*_kinds(schema), T.StructField(BROKEN, T.StringType())])
    parsed = F.from_json("text", kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    lines = numbered_lines(spark, path).withColumnRenamed("value", "text").filter(F.trim("text") != "")
    return lines.select(*SOURCE, "text", parsed.alias("row_"))


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType, source: bool = False) -> DataFrame:
    """One row per JSON line; lines that are no JSON object of this schema are left out.

    ``source`` adds ``file, block, row``, the place of each line. ``read_json_lines_checked`` lists the broken lines.
    """
    if not source:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    rows = _json_rows(spark, path, schema)
    return rows.filter(F.col(f"row_.{BROKEN}").isNull()).select(*SOURCE, "row_.*").drop(BROKEN)


def read_json_lines_checked(spark: SparkSession, path: str, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows with their place, and rejects: ``file, block, row, reason, text``."""
    rows = _json_rows(spark, path, schema)
    broken = F.col(f"row_.{BROKEN}").isNotNull()
    good = rows.filter(~broken).select(*SOURCE, "row_.*").drop(BROKEN)
    return good, rows.filter(broken).select(*SOURCE, F.lit("not a JSON object of the declared fields").alias("reason"), "text")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def take_first(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """The first ``n`` rows of a split, by id so that a re-run takes the same ones."""
    return df.orderBy(id_col).limit(n)


def keyset_page(df: DataFrame, id_col: str, n: int, cursor: object | None = None) -> DataFrame:
    """The page of ``n`` rows after ``cursor``; an empty page ends the scan.

    For clients that page. A full export just reads the table.
    """
    rest = df if cursor is None else df.filter(F.col(id_col) > F.lit(cursor))
    return rest.orderBy(id_col).limit(n)


def fetch_by_ids(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id is asked for; Spark broadcasts the id list when it is small."""
    return df.join(ids.select(id_col), id_col, "left_semi")


def date_slice(df: DataFrame, date_col: str | Column, run_date: str) -> DataFrame:
    """The rows dated the day before ``run_date``.

    On a table partitioned by the date this prunes to one partition; on a
    timestamp column, pass the column and the range reaches the scan.
    """
    col = F.col(date_col) if isinstance(date_col, str) else date_col
    day = day_before(run_date)
    return df.filter((col >= day) & (col < F.date_add(day, 1)))


def random_vectors(spark: SparkSession, n: int, dims: int, seed: int = 0) -> DataFrame:
    """``n`` vectors of uniform numbers in [0, 1), the same for the same seed."""
    scale = float(2**53)
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.transform(
            F.sequence(F.lit(1), F.lit(dims)),
            lambda i: (
                F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("id"), i), 11).cast("double") / scale
            ).cast("float"),
        ).alias("values"),
    )
