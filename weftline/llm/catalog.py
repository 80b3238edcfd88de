"""The registered queries of this subpackage and, where SQL can say them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Job], Job]:
    def add(job: Job) -> Job:
        QUERIES[job.__name__] = job
        if sql is not None:
            ORACLES[job.__name__] = sql
        return job

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def piece_model() -> str:
    """The public BPE model file; another model is another path for the operator."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


@query()
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.quality_model import quality_scores

    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(~held_out())
    return quality_scores(docs, labels).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query()
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.secrets import secret_scan

    return secret_scan(table(spark, folder, "documents"))


@query()
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.sharding import deal

    return deal(table(spark, folder, "documents"))


@query()
def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.ngram_join import near_duplicate_groups

    return near_duplicate_groups(table(spark, folder, "documents"))


@query()
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.quality_rules import quality_rules

    return quality_rules(table(spark, folder, "documents"))


@query()
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.mixing import mix

    return mix(table(spark, folder, "documents"))


@query()
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.pieces import round_trip

    return round_trip(table(spark, folder, "documents"), piece_model())


@query(
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
    ), r AS (
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """
)
def op8_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.topk import top_k

    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query()
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.pii import personal_data

    return personal_data(table(spark, folder, "documents"))


@query()
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.substring_dedup import substring_dedup

    return substring_dedup(table(spark, folder, "documents"))


@query(
    """
    WITH v AS (
      SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS MATERIALIZED (
      SELECT a.vec_id AS anchor_id, a.label AS anchor_label, a.v AS anchor_v, c.vec_id, a.label = c.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
    ), p AS (
      SELECT * FROM (
        SELECT anchor_id, anchor_label, anchor_v, vec_id AS positive_id, score AS positive_score,
               row_number() OVER (PARTITION BY anchor_id, anchor_label, anchor_v ORDER BY score DESC, vec_id) AS place
        FROM s WHERE same
      ) WHERE place <= 5
    ), n AS (
      SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, p.anchor_label, p.anchor_v, positive_id, place
                                     ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.anchor_label = p.anchor_label AND s.anchor_v = p.anchor_v
      WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
    )
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """
)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.hard_negatives import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").withColumn("label", label)
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


@query(
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
    ), r AS (
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
      FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """
)
def op13_rotated_codes(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.rotated_codes import nearest

    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query(
    r"""
    WITH d AS (
      SELECT coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents
    ), p AS (
      SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
    ), w AS MATERIALIZED (
      SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
    ), g AS (
      SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase, k
      FROM w, range(1, 6) t(k) WHERE len(w) >= k
    ), f AS MATERIALIZED (
      SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY lang, phrase, k HAVING count(*) >= 100
    ), n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
    c AS MATERIALIZED (SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
    cut AS (
      SELECT lang, phrase, size, a, w, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
      FROM c, range(1, 5) t(k) WHERE k < size
    ), s AS (
      SELECT cut.lang, cut.phrase, cut.a, cut.k, x.f AS l, y.f AS r, n.n,
             CAST((1000::HUGEINT * cut.a * n.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.lp JOIN f y ON y.lang = cut.lang AND y.phrase = cut.rp
      JOIN n ON n.lang = cut.lang
    ), low AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM s) WHERE place = 1
    ), inner_part AS (
      SELECT DISTINCT c.lang, array_to_string(c.w[i:i + k - 1], ' ') AS phrase, c.a AS longer
      FROM c, range(2, 5) t(k), range(1, 5) u(i) WHERE k < c.size AND i + k - 1 <= c.size
    ), kept AS (
      SELECT low.* FROM low WHERE NOT EXISTS (
        SELECT 1 FROM inner_part x WHERE x.lang = low.lang AND x.phrase = low.phrase AND 100 * x.longer >= 100 * low.a)
    ), ranked AS (
      SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
      FROM kept
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """
)
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    from weftline.llm.phrases import collocations

    return collocations(table(spark, folder, "documents"))
