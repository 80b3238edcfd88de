"""Nested to flat, wide to long, labels to columns. Every operator works row by row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import bool_text, or_empty


def explode_records(df: DataFrame, array_col: str, pos: str | None = None) -> DataFrame:
    """One row per array element, struct fields as columns; the child wins over the parent.

    ``pos`` adds the position in the array, from 0.
    """
    fields = df.schema[array_col].dataType.elementType.names
    parent = [c for c in df.columns if c != array_col and c not in fields]
    if pos is None:
        return df.select(*parent, F.explode(array_col).alias("_r")).select(*parent, "_r.*")
    exploded = df.select(*parent, F.posexplode(array_col).alias(pos, "_r"))
    return exploded.select(*parent, pos, "_r.*")


def flatten_fields(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Nested paths as flat columns: ``{"title": "meta.title"}``."""
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def first_of(items: Column) -> Column:
    """The first element of an array; null when it is empty or null."""
    return F.try_element_at(items, F.lit(1))


def last_of(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def spoken(sentences: Column) -> tuple[Column, Column, Column]:
    """Text, start and end of an utterance that is an array of timed sentences."""
    text = F.array_join(F.transform(sentences, lambda s: or_empty(s["text"])), "\n")
    return text, first_of(sentences)["start"], last_of(sentences)["end"]


def wide_to_long(
    df: DataFrame,
    groups: Sequence[Sequence[str]],
    names: Sequence[str],
    group_col: str = "group_no",
    required: str | None = None,
) -> DataFrame:
    """Repeating column groups as rows, numbered from 0; rows without ``required`` are dropped."""
    used = {c for group in groups for c in group}
    keep = [c for c in df.columns if c not in used]
    rows = F.array(
        *[
            F.struct(F.lit(i).alias(group_col), *[F.col(c).alias(n) for c, n in zip(group, names)])
            for i, group in enumerate(groups)
        ]
    )
    long = df.select(*keep, F.explode(rows).alias("_r")).select(*keep, "_r.*")
    if required is not None:
        long = long.filter(F.col(required).isNotNull() & (F.col(required) != ""))
    return long


def known_labels(labels: Column) -> Column:
    """Label names of a comma list in the spelling of the flag columns."""

    def spelled(label: Column) -> Column:
        return (
            F.when(
                F.contains(label, F.lit("Category")),
                F.trim(F.replace(label, F.lit("Category "), F.lit("Category_"))),
            )
            .when(
                F.contains(label, F.lit("IMAP_$Forwarded")) | F.contains(label, F.lit("IMAP_Forwarded")),
                F.lit("IMAP_Forwarded"),
            )
            .otherwise(label)
        )

    return F.transform(F.split(labels, ","), lambda x: spelled(F.trim(x)))


def label_flags(
    df: DataFrame, labels_col: str, vocabulary: Sequence[str], as_text: bool = False
) -> DataFrame:
    """One flag column per name of a fixed vocabulary; other labels are ignored."""
    found = df.withColumn("_known", F.coalesce(known_labels(F.col(labels_col)), F.array().cast("array<string>")))
    flags = {}
    for name in vocabulary:
        flag = F.array_contains("_known", name)
        flags[name] = bool_text(flag) if as_text else flag
    return found.withColumns(flags).drop("_known")


def text_fields(df: DataFrame) -> list[str]:
    """The names of the plain text columns of a table."""
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]


def text_properties(schema_doc: DataFrame) -> DataFrame:
    """Class and property name of every property whose declared type is exactly ``text``."""
    one = schema_doc.select(F.explode("classes").alias("c"))
    plain = F.filter("c.properties", lambda p: p["dataType"] == F.array(F.lit("text")))
    return one.select(F.col("c.class").alias("class"), F.explode(plain).alias("p")).select(
        "class", F.col("p.name").alias("name")
    )
