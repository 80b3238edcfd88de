"""Topic groups with labels, and the map table of a collection."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.embed import Embedder, embed, words
from weftline.storage import cut, written


def assign_topics(df: DataFrame, vec: str = "embedding", n_topics: int = 8, seed: int = 7) -> DataFrame:
    """Add a ``topic`` number by k-means on the vectors; null for rows without a vector."""
    features = array_to_vector(F.col(vec).cast("array<double>")).alias("_features")
    # The rounds pass over the vectors alone; a lost part is read again.
    vectors = df.filter(F.col(vec).isNotNull()).select(features).persist()
    model = KMeans(k=n_topics, seed=seed, featuresCol="_features", predictionCol="topic").fit(vectors)
    vectors.unpersist()
    ready = df.filter(F.col(vec).isNotNull()).select("*", features)
    none = df.filter(F.col(vec).isNull()).withColumn("topic", F.lit(None).cast("int"))
    return model.transform(ready).drop("_features").unionByName(none)


def topic_labels(df: DataFrame, text_col: str, n_terms: int = 3) -> DataFrame:
    """The terms that mark each topic: ``topic, label``.

    A term scores by how often it occurs in the topic times how rare it is among
    all documents. Counts are merged before each shuffle, and only ``n_terms``
    rows per topic are put together.
    """
    terms = df.filter("topic IS NOT NULL").select("topic", F.explode(F.array_distinct(words(F.col(text_col)))).alias("term"))
    per_topic = cut(terms.groupBy("topic", "term").agg(F.count(F.lit(1)).alias("n")))
    overall = per_topic.groupBy("term").agg(F.sum("n").alias("docs"))
    n_docs = df.filter("topic IS NOT NULL").count()
    scored = per_topic.join(overall, "term").withColumn(
        "score", F.round(F.col("n") * F.log((F.lit(n_docs) + 1.0) / F.col("docs")), 9)
    )
    best = Window.partitionBy("topic").orderBy(F.desc("score"), "term")
    top = scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n_terms)
    return top.groupBy("topic").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "term"))), lambda t: t["term"]), ", "
        ).alias("label")
    )


def topics(df: DataFrame, text_col: str, vec: str = "embedding", n_topics: int = 8, seed: int = 7) -> DataFrame:
    """Rows with their ``topic`` and its ``label``; the label table has one row per topic.

    The table is passed over many times, so it is written once first: vectors
    that a model made are not made again, and passes read only the columns they need.
    """
    assigned = assign_topics(written(df, "topics"), vec, n_topics, seed)
    labels = cut(topic_labels(assigned, text_col))
    return assigned.join(F.broadcast(labels), "topic", "left")


def plane(df: DataFrame, vec: str = "embedding") -> DataFrame:
    """Add ``x`` and ``y``: the two directions in which the vectors differ most; null for rows without a vector."""
    ready = df.filter(F.col(vec).isNotNull()).withColumn("_features", array_to_vector(F.col(vec).cast("array<double>")))
    model = PCA(k=2, inputCol="_features", outputCol="_plane").fit(ready.select("_features"))
    placed = (
        model.transform(ready)
        .withColumn("_xy", vector_to_array("_plane"))
        .withColumns({"x": F.col("_xy")[0], "y": F.col("_xy")[1]})
        .drop("_features", "_plane", "_xy")
    )
    none = F.lit(None).cast("double")
    return placed.unionByName(df.filter(F.col(vec).isNull()).withColumns({"x": none, "y": none}))


def build_index(
    df: DataFrame,
    id_col: str,
    text_col: str,
    vec: str | None = None,
    fn: Embedder | None = None,
    n_topics: int = 8,
    seed: int = 7,
) -> DataFrame:
    """The map table of a collection: ``id, x, y, topic, label``.

    Vectors are made from ``text_col`` unless ``vec`` names them.
    """
    name = vec or "embedding"
    vectors = (df if vec else embed(df, text_col, fn)).select(id_col, text_col, name)
    mapped = plane(topics(vectors, text_col, name, n_topics, seed), name)
    return mapped.select(F.col(id_col).alias("id"), "x", "y", "topic", "label")
