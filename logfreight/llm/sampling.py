"""Bounded, repeatable samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, label: str, bound: int, key: str = "doc_id") -> DataFrame:
    """At most ``bound`` rows of each label: those with the lowest hash of their key.

    Rows are cut by a threshold on the hash first, from the counts of labels, so that ranking
    sees about twice the bound per label and no more, however many rows a label has.
    """
    hashed = rows.withColumn("_h", F.xxhash64(F.lit("sample"), key))
    counts = rows.groupBy(label).agg(F.count("*").alias("_n"))
    # Only labels with more rows than that need a cut, so there are few of them: at most one for
    # every 2 * bound rows, and those that Spark finds small enough it sends to all tasks.
    large = counts.filter(F.col("_n") > 2 * bound)
    share = F.lit(2.0 * bound) / F.col("_n")
    cut = large.select(F.col(label).alias("_label"), ((share * 2 - 1) * F.lit(float(2**63))).alias("_cut"))
    told = hashed.join(F.broadcast(cut), F.col(label) == F.col("_label"), "left")
    near = told.filter(F.col("_cut").isNull() | (F.col("_h") <= F.col("_cut"))).drop("_label")
    order = Window.partitionBy(label).orderBy("_h", key)
    ranked = near.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= bound)
    return ranked.drop("_h", "_cut", "_r")
