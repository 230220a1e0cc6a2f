"""The subpackage's registered queries and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fleetgauge.llm import (
    html_template,
    kneser_ney,
    language_id,
    mixing,
    ngram_join,
    ppm,
    private_data,
    quality_rules,
    resampling,
    sentencepiece_codec,
    topk_search,
    url_reputation,
    whitening,
)
from fleetgauge.llm.ship import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.held_out_identification(_table(spark, sf_dir, "documents"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP2_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.w) = len(c.w)
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"))


def op4_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(_table(spark, sf_dir, "pages"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    outcomes = url_reputation.labelled_outcomes(pages, _table(spark, sf_dir, "labels"))
    return url_reputation.judge_urls(pages, outcomes)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.schedule(docs).drop("text")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(corpus_pipeline.PIECES)
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, path), path)
    exact = F.col("decoded").eqNullSafe(F.translate("text", sentencepiece_codec.BLANK, " "))
    return coded.select("doc_id", "ids", F.size("ids").alias("n_ids"), exact.alias("exact"))


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(_table(spark, sf_dir, "embeddings")))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# crc32 is the table-driven one; "steps" is its table, made by eight shifts of each index.
OP12_SQL = """
WITH RECURSIVE shifted AS (
    SELECT i, i AS v, 0 AS k FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
    UNION ALL
    SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1
    FROM shifted WHERE k < 8
), steps AS (
    SELECT list(v ORDER BY i) AS step FROM shifted WHERE k = 8
), word_lists AS (
    SELECT 0 AS kind, doc_id AS id, {words} AS words FROM documents
    UNION ALL
    SELECT 1, item_id, {words} FROM benchmark
), features AS (
    SELECT kind, id, unnest(words) AS word FROM word_lists
), spelt AS (
    SELECT word, list_transform(
        range(1, CAST(octet_length(encode(word)) AS BIGINT) + 1),
        lambda j: CAST(('0x' || substr(hex(encode(word)), 2 * j - 1, 2)) AS BIGINT)
    ) AS bytes
    FROM (SELECT DISTINCT word FROM features)
), hashed AS (
    SELECT word, xor(
        list_reduce(
            list_prepend(4294967295, bytes),
            lambda state, b: xor(step[(xor(state, b) & 255) + 1], state >> 8)
        ), 4294967295) % 10000 AS bucket
    FROM spelt, steps
), placed AS (
    SELECT kind, id, bucket FROM features JOIN hashed USING (word)
), totals AS (
    SELECT count(*) FILTER (kind = 0) AS held, count(*) FILTER (kind = 1) AS aimed FROM placed
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln(
        ((t + 1) * (held + 10000))::DOUBLE / ((s + 1) * (aimed + 10000)))) AS BIGINT) AS gain
    FROM (SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t
          FROM placed GROUP BY bucket), totals
), weights AS (
    SELECT id AS doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
    FROM placed JOIN gains USING (bucket) WHERE kind = 0 GROUP BY id
), scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
               CAST(('0x' || substr(sha256('2024:' || d.doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE
           ) / 4294967296))) AS BIGINT) AS score
    FROM documents d LEFT JOIN weights USING (doc_id)
), placed_by_score AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
           count(*) FILTER (n_features >= 20) OVER () AS able
    FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
FROM placed_by_score
""".replace(
    "{words}",
    "coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])",
)


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.counted(
        private_data.find_private_data(_table(spark, sf_dir, "documents"))
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    named = (
        op1_language_id,
        op2_topk_search,
        op3_ngram_join,
        op4_html_template,
        op5_kneser_ney,
        op6_url_reputation,
        op7_mixing,
        op8_sentencepiece,
        op9_ppm,
        op10_quality_rules,
        op11_whitening,
        op12_resampling,
        op13_private_data,
        pipeline,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op2_topk_search": OP2_SQL, "op12_resampling": OP12_SQL}
