"""From documents to training sequences: toxicity, language, near copies, repeats, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; ``run`` writes
what a stage returns as Parquet and reads it again. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logfreight.llm import language, packing, probminhash, suffix_dedup, toxicity
from logfreight.llm.texts import as_rows, documents, fresh
from logfreight.session import prepare, written_table


def clean_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject (score under 0.5)."""
    prepare(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rated = toxicity.with_toxicity(as_rows(docs), model)
    return rated.filter(F.col("toxicity") < 0.5).select("row.*")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a language; null, empty and letterless texts go."""
    prepare(spark)
    told = language.with_language(as_rows(docs), language.train(docs))
    return told.filter(~F.col("lang_rejected")).select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that with the least doc_id."""
    prepare(spark)
    return probminhash.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what documents before them have; characters cut apart are dropped.

    Every document stays, if need be with an empty text; n_chars follows the text.
    """
    prepare(spark)

    @F.pandas_udf("string")
    def as_text(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: b.decode("utf-8", "ignore"))

    name = fresh(docs, "_removal")
    told = suffix_dedup.without_repeats(docs, name=name).withColumn("text", as_text(F.col(f"{name}.kept")))
    if "n_chars" in docs.columns:
        told = told.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return told.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048: every piece with its ids and its place."""
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", clean_only),
    ("language", known_language),
    ("near_copies", without_near_copies),
    ("repeated_passages", without_repeated_passages),
    ("packing", packed),
]

# A classifier, sketches and a local search are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
