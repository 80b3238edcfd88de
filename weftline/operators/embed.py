"""Turning text into vectors: a slot for any model, and a model-free default."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Embedder = Callable[[DataFrame, str], DataFrame]


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def hashed_tfidf(corpus: DataFrame, text_col: str, dims: int = 256) -> Embedder:
    """Fit hashed TF-IDF on a corpus; the result embeds that corpus and its queries alike.

    This is word statistics, not a neural model: it finds shared words, not
    shared meaning. Only ``dims`` document counts come back to the driver.
    """
    hashing = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dims)

    def counted(df: DataFrame, col: str) -> DataFrame:
        return hashing.transform(df.withColumn("_words", words(F.coalesce(F.col(col), F.lit("")))))

    idf = IDF(inputCol="_tf", outputCol="_tfidf").fit(counted(corpus, text_col).select("_tf"))
    unit = Normalizer(inputCol="_tfidf", outputCol="_unit", p=2.0)

    def apply(df: DataFrame, col: str) -> DataFrame:
        out = unit.transform(idf.transform(counted(df, col)))
        return out.withColumn("embedding", vector_to_array("_unit", "float32")).drop(
            "_words", "_tf", "_tfidf", "_unit"
        )

    return apply


def model_embedder(
    load: Callable[[], Callable[[list[str], str], np.ndarray]], task: str = "search_document"
) -> Embedder:
    """Embed with a model that ``load`` builds once per Python worker.

    The model takes a batch of texts and the task name (documents and queries
    may be embedded differently) and returns one vector per text.
    """

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            vectors = np.asarray(model(texts.fillna("").tolist(), task), dtype=np.float32)
            yield pd.Series(list(vectors))

    return lambda df, col: df.withColumn("embedding", encode(F.col(col)))


def embed(df: DataFrame, text_col: str, fn: Embedder | None = None, max_chars: int | None = None) -> DataFrame:
    """Add an ``embedding`` column; ``max_chars`` cuts the text first where a model asks for it."""
    fn = fn or hashed_tfidf(df, text_col)
    if max_chars is None:
        return fn(df, text_col)
    cut_text = df.withColumn("_cut", F.substring(text_col, 1, max_chars))
    return fn(cut_text, "_cut").drop("_cut")
