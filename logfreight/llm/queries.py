"""One query per operator of this subpackage, over whole tables, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logfreight.llm import (
    bpe,
    hmm,
    language,
    negatives,
    packing,
    probminhash,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
    vectors,
    whitening,
    winnowing,
)
from logfreight.llm.texts import documents, held_out
from logfreight.session import prepare, scratch


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = documents(spark, sf_dir), scratch(spark, "tokens")
    token_files.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.with_crc32(token_files.read_token_files(spark, path))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    told = language.with_language(docs.select(F.col("doc_id").cast("bigint"), "text"), language.train(docs))
    return told.select(
        "doc_id",
        held_out(F.col("doc_id"), language.FOLDS, 0).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.cut_documents(documents(spark, sf_dir), path)
    placed = packing.place_pieces(pieces)
    return token_files.with_crc32(pieces).join(placed, "piece_key").drop("piece_key")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rated = toxicity.with_toxicity(docs.select(F.col("doc_id").cast("bigint"), "text"), model)
    return rated.select(
        "doc_id",
        held_out(F.col("doc_id"), toxicity.FOLDS, 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "toxic_passages",
    )


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.select(F.col("vec_id").cast("bigint").alias("id"), vectors.scaled(F.col("embedding")).alias("components"))
    return vectors.top_k(rows.filter(F.col("id") % 20 == 0), rows, 20)


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_fingerprints(documents(spark, sf_dir))


def op9_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return hmm.score(docs, hmm.train(docs))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    kept = suffix_dedup.without_repeats(docs.select("doc_id", "text"))
    return kept.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("_removal.n_bytes"),
        F.col("_removal.n_removed"),
        F.col("_removal.n_spans"),
        F.sha2(F.col("_removal.kept"), 256).alias("kept_sha256"),
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_copies(documents(spark, sf_dir))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.select(F.col("vec_id").cast("bigint").alias("id"), vectors.scaled(F.col("embedding"), 256.0).alias("components"))
    return whitening.whitened(rows).withColumnRenamed("id", "vec_id")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vec_id, label = F.col("vec_id").cast("bigint"), F.col("label").cast("bigint")
    rows = table.select(
        vec_id.alias("id"),
        F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        vectors.scaled(F.col("embedding"), 256.0).alias("components"),
    )
    return negatives.hard_negatives(rows, "id % 100 = 0")


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files, op2_language, op3_bpe, op4_probminhash, op5_packing, op6_toxicity, op7_vectors,
        op8_winnowing, op9_hmm, op10_suffix_dedup, op11_simhash, op12_whitening, op13_hard_negatives,
    )
}
ORACLES = {
    "op7_vectors": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.c, v.c) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id AND len(q.c) = len(v.c)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same,
    CAST(list_inner_product(a.c, v.c) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND v.vec_id <> a.vec_id AND len(a.c) = len(v.c)
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS n
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE n <= 10
""",
}
