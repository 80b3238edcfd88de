"""Queries over vectors: search, recall, near duplicates, topics, maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.vectors import unit
from weftline.operators import census, chunk, dedupe, embed, enrich, neardup, search, topics
from weftline.plans.catalog import query, table


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _centres(corpus: DataFrame, *group: str) -> DataFrame:
    """The mean vector of each group: one number per group and place, merged before the shuffle."""
    places = corpus.select(*group, F.posexplode("embedding").alias("pos", "x"))
    means = places.groupBy(*group, "pos").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    # One row per vector place, so a list is as long as a vector.
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"])
    return means.groupBy(*group).agg(listed.alias("embedding"))


def _label_queries(corpus: DataFrame) -> DataFrame:
    return _centres(corpus, "label").select(F.col("label").cast("bigint").alias("qid"), "embedding")


def _one_query(corpus: DataFrame) -> DataFrame:
    return _centres(corpus).select(F.lit(0).cast("bigint").alias("qid"), "embedding")


def _rounded(hits: DataFrame, *fields: str) -> DataFrame:
    return hits.select("qid", "id", F.round("score", 4).alias("score"), "rank", *fields)


_CORPUS_SQL = "c AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings)"
_MEANS_SQL = """
    p AS (SELECT id, label, unnest(v) AS x, unnest(range(len(v))) AS pos FROM c),
    q AS (SELECT label::BIGINT AS qid, list(x ORDER BY pos) AS v FROM (
      SELECT label, pos, round(avg(x), 6) AS x FROM p GROUP BY label, pos) GROUP BY label)"""
_MEAN_SQL = """
    p AS (SELECT id, label, unnest(v) AS x, unnest(range(len(v))) AS pos FROM c),
    q AS (SELECT 0::BIGINT AS qid, list(x ORDER BY pos) AS v FROM (
      SELECT pos, round(avg(x), 6) AS x FROM p GROUP BY pos))"""


def _short_sql(name: str, source: str, key: str, dims: int) -> str:
    return f"""{name} AS (SELECT {key}, list_transform(h, lambda x: x / n) AS v FROM (
      SELECT {key}, v[1:{dims}] AS h, sqrt(list_inner_product(v[1:{dims}], v[1:{dims}])) AS n FROM {source})
      WHERE n > 0)"""


def _top_sql(
    queries: str = "q", corpus: str = "c", k: int = 10, score: str = "list_inner_product(q.v, c.v)", order: str = "DESC"
) -> str:
    return f"""SELECT qid, id, score, rank FROM (
      SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 12) {order}, id)::INTEGER AS rank
      FROM (SELECT q.qid, c.id, {score} AS score FROM {queries} q, {corpus} c)) WHERE rank <= {k}"""


_ROUNDED_SQL = "SELECT qid, id, round(score, 4) AS score, rank"


@query(f"WITH {_CORPUS_SQL}, {_MEAN_SQL} {_ROUNDED_SQL} FROM ({_top_sql()})")
def knn_exact(spark: SparkSession, d: str) -> DataFrame:
    """The vectors nearest to the mean of all."""
    corpus = _corpus(spark, d)
    return _rounded(search.knn(_one_query(corpus), corpus, 10))


@query(
    f"""WITH {_CORPUS_SQL}, {_MEANS_SQL}
    SELECT qid, h.id, round(score, 4) AS score, rank, c.label FROM ({_top_sql()}) h JOIN c ON c.id = h.id"""
)
def knn_batch(spark: SparkSession, d: str) -> DataFrame:
    """For every label the vectors nearest to its mean, with a field of theirs."""
    corpus = _corpus(spark, d)
    return _rounded(search.knn(_label_queries(corpus), corpus, 10, fields=["label"]), "label")


@query(
    f"""WITH {_CORPUS_SQL}, q AS (SELECT id AS qid, v FROM c)
    {_ROUNDED_SQL} FROM ({_top_sql(k=5)})"""
)
def knn_all(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest of every vector, itself among them."""
    corpus = _corpus(spark, d)
    return _rounded(search.knn(corpus.select(F.col("id").alias("qid"), "embedding"), corpus, 5))


@query(
    f"""WITH {_CORPUS_SQL}, {_MEANS_SQL}
    {_ROUNDED_SQL} FROM ({_top_sql(score="list_distance(q.v, c.v)", order="ASC")})"""
)
def knn_euclid(spark: SparkSession, d: str) -> DataFrame:
    corpus = _corpus(spark, d)
    return _rounded(search.knn(_label_queries(corpus), corpus, 10, metric="euclidean"))


@query(
    f"""WITH {_CORPUS_SQL}, {_MEANS_SQL}, {_short_sql("qs", "q", "qid", 32)}, {_short_sql("cs", "c", "id", 32)}
    {_ROUNDED_SQL} FROM ({_top_sql("qs", "cs")})"""
)
def knn_truncated(spark: SparkSession, d: str) -> DataFrame:
    corpus = _corpus(spark, d)
    return _rounded(search.knn(_label_queries(corpus), corpus, 10, dims=32))


_RERANK_SQL = f"""{_short_sql("qs", "q", "qid", 16)}, {_short_sql("cs", "c", "id", 16)},
    few AS ({_top_sql("qs", "cs", 100)}),
    pairs AS (SELECT few.qid, few.id, list_inner_product(q.v, c.v) AS score
              FROM few JOIN q ON q.qid = few.qid JOIN c ON c.id = few.id),
    best AS (SELECT * FROM (SELECT qid, id, score,
              row_number() OVER (PARTITION BY qid ORDER BY round(score, 12) DESC, id)::INTEGER AS rank FROM pairs)
             WHERE rank <= 10)"""


@query(f"WITH {_CORPUS_SQL}, {_MEANS_SQL}, {_RERANK_SQL} {_ROUNDED_SQL} FROM best")
def knn_rerank(spark: SparkSession, d: str) -> DataFrame:
    corpus = _corpus(spark, d)
    return _rounded(search.knn_rerank(_label_queries(corpus), corpus, 16, 10, 10))


@query(
    f"""WITH {_CORPUS_SQL}, {_MEANS_SQL}, {_RERANK_SQL}, exact AS ({_top_sql()})
    SELECT exact.qid, count(best.id) AS shared, count(best.id) / count(*) AS recall
    FROM exact LEFT JOIN best ON best.qid = exact.qid AND best.id = exact.id GROUP BY exact.qid"""
)
def knn_recall(spark: SparkSession, d: str) -> DataFrame:
    corpus = _corpus(spark, d)
    queries = _label_queries(corpus)
    return search.recall(search.knn_rerank(queries, corpus, 16, 10, 10), search.knn(queries, corpus, 10))


@query(
    f"""WITH {_CORPUS_SQL}, {_MEAN_SQL}, {_short_sql("qs", "q", "qid", 32)}, {_short_sql("cs", "c", "id", 32)},
    a AS ({_top_sql(k=50)}), b AS ({_top_sql("qs", "cs", 50)})
    SELECT count(*) AS shared FROM (SELECT id FROM a INTERSECT SELECT id FROM b)"""
)
def result_overlap(spark: SparkSession, d: str) -> DataFrame:
    corpus = _corpus(spark, d)
    one = _one_query(corpus)
    full = search.knn(one, corpus, 50)
    short = search.knn(search.truncate(one, 32), search.truncate(corpus, 32), 50)
    return dedupe.overlap(full, short, "id")


@query(
    f"""WITH {_CORPUS_SQL}, n AS (SELECT id, v, sqrt(list_inner_product(v, v)) AS n FROM c)
    SELECT id, round(n, 4) AS norm, round(v[1] / n, 4) AS first, round(v[-1] / n, 4) AS last FROM n"""
)
def unit_vectors(spark: SparkSession, d: str) -> DataFrame:
    from weftline.functions.vectors import norm

    v = unit(F.col("embedding"))
    return _corpus(spark, d).select(
        "id",
        F.round(norm(F.col("embedding")), 4).alias("norm"),
        F.round(F.element_at(v, 1), 4).alias("first"),
        F.round(F.element_at(v, -1), 4).alias("last"),
    )


@query(
    """
    SELECT d.doc_id, d.lang, e.label, len(e.embedding)::INTEGER AS dims
    FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id
    """
)
def aligned_vectors(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    rows = enrich.align_vectors(table(spark, d, "documents").select("doc_id", "lang"), vectors, "doc_id")
    return rows.select("doc_id", "lang", "label", F.size("embedding").alias("dims"))


@query(
    """
    SELECT coalesce(doc_id, vec_id) AS doc_id, (doc_id IS NOT NULL)::INTEGER AS has_row,
           (vec_id IS NOT NULL)::INTEGER AS has_vector
    FROM documents FULL JOIN embeddings ON doc_id = vec_id WHERE doc_id IS NULL OR vec_id IS NULL
    """
)
def unaligned_vectors(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return enrich.unaligned(table(spark, d, "documents"), vectors, "doc_id")


@query(
    f"""WITH {_CORPUS_SQL}, {_MEANS_SQL}, h AS ({_top_sql(k=3)}),
    f AS (SELECT h.qid, h.rank, {{'id': h.id, 'lang': d.lang, 'text': d.text}} AS r
          FROM h JOIN documents d ON d.doc_id = h.id)
    SELECT qid, count(*)::INTEGER AS n_rows,
      'Context:' || chr(10) || to_json(list(r ORDER BY rank))::VARCHAR || chr(10) || chr(10) || 'Question: ' ||
      'what is label ' || qid || '?' AS prompt
    FROM f GROUP BY qid"""
)
def rag_context(spark: SparkSession, d: str) -> DataFrame:
    """The three best documents of every label's query, as one prompt each."""
    corpus = _corpus(spark, d)
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "text")
    hits = search.knn(_label_queries(corpus), corpus, 3)
    asked = F.concat(F.lit("what is label "), F.col("qid").cast("string"), F.lit("?"))
    found = search.with_fields(hits, docs, ["lang", "text"]).withColumn("question", asked)
    return chunk.rag_context(found, ["id", "lang", "text"], "question")


@query()
def text_search(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark items against all documents over hashed TF-IDF, three best each."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    fn = embed.hashed_tfidf(docs, "text")
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), "text")
    return search.knn(fn(items, "text"), fn(docs, "text"), 3, fields=["lang"])


@query(
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
      FROM documents
    ), s AS MATERIALIZED (
      SELECT DISTINCT id, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
      FROM w
    ), n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
    met AS (SELECT a.id AS a, b.id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.id <> b.id GROUP BY a.id, b.id),
    links AS MATERIALIZED (
      SELECT a, b FROM met JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
    ),
    reached AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other)
    SELECT id, min(other) AS keep_id FROM reached GROUP BY id
    """
)
def near_dups(spark: SparkSession, d: str) -> DataFrame:
    """Near copies among all documents, by the five-word shingles of the whole texts."""
    return neardup.near_dups(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"))


@query()
def topic_model(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    modelled = topics.topics(embed.embed(docs, "text"), "text", n_topics=8)
    return census.facets(modelled, "topic", "label")


@query()
def index_2d(spark: SparkSession, d: str) -> DataFrame:
    """The map table of all documents."""
    return topics.build_index(table(spark, d, "documents"), "doc_id", "text")


@query()
def index_of_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The map table of documents that bring their vectors."""
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    rows = enrich.align_vectors(table(spark, d, "documents"), vectors, "doc_id")
    return topics.build_index(rows, "doc_id", "text", vec="embedding")
