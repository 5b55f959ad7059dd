"""Documents with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import pathlib

import duckdb
from pyspark.sql import types as T

# Names that operators use for columns of their own.
EXTRA = ("part", "node", "word", "class_id", "score", "start", "row_id", "grp", "kept", "toxicity", "toxic_passages",
         "lang_pred", "lang_rejected", "_told", "_rated", "_grp", "_doc", "_text", "_node", "_removal", "row")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(name, T.StringType()) for name in EXTRA],
    ]
)
SHARED = "a passage that several of these documents hold word for word, é and all, to the end of it. "
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly box up old jugs of wine "


def odd_documents() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, lang): nulls, empties, ties, repeated rows, long texts, odd white space."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(20_000))
    return [
        (1, PROSE * 3, "en"),
        (2, PROSE * 3, "en"),
        (3, PROSE * 3 + "and one more", "en"),
        (4, None, "en"),
        (5, "", None),
        (6, "   \n\t  ", "en"),
        (7, "x", "en"),
        (8, long, "en"),
        (9, "one two three " + SHARED + "four five six", "en"),
        (10, "seven eight " + SHARED + "nine ten", "fr"),
        (11, SHARED[:40] + SHARED, "fr"),
        (11, "repeated id, other text: " + SHARED, "fr"),
        (12, "same row twice " * 9, "de"),
        (12, "same row twice " * 9, "de"),
        (None, SHARED + PROSE, "en"),
        (None, None, None),
        (13, "a  b\t\tc\n\n\nd   e <|endoftext|>\n\n<|endoftext|> 　 f's IT'LL \x1c 12 345 ½", "en"),
        (14, "日本語のテキスト" * 40, "ja"),
        (15, "12345 67890 !!! ???", "en"),
        (16, "a" * 5000, "en"),
        (17, "ab" * 3000 + "\U0001f600" * 100, "en"),
        (-3, "negative ids sort first " + SHARED, "en"),
    ]


def frame(spark, rows):
    """A table of ``documents`` with columns of clashing names; null n_chars and source too."""
    full = [(i, text, lang, None, None, *EXTRA) for i, text, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


def given(folder: str) -> list[tuple[int, str, str]]:
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def written(spark, tmp_path: pathlib.Path, rows, labels=()) -> str:
    """A folder with ``documents`` and ``labels``."""
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)
