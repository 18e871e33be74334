"""A corpus of documents made ready for training: five operators of ``receiptflow.llm`` in a row.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps; all but the last with the columns of
``documents``. What a stage returns is written as Parquet and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from receiptflow.llm.decontaminate import decontaminate
from receiptflow.llm.jaccard_join import keep_one_of_each
from receiptflow.llm.language_id import identify
from receiptflow.llm.line_dedup import WORD, dedup_lines
from receiptflow.llm.queries import PIECE_MODEL
from receiptflow.llm.sentencepiece_codec import encode_texts
from receiptflow.llm.shared import drop_written, written


def _only(docs: DataFrame, columns: list[str]) -> DataFrame:
    """These columns of ``docs``, whatever characters their names have."""
    return docs.select(*[F.col(f"`{c.replace('`', '``')}`") for c in columns])


def _with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """``columns`` of ``docs`` with the text from the column ``text``, and its length where there is one for it."""
    new = {"text": F.col(text)} | ({"n_chars": F.length(text).cast("long")} if "n_chars" in columns else {})
    return _only(docs.withColumns(new), columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, under the predicted one; those without a text or a letter in it go.

    The network learns from the labels of all documents that come in.
    """
    found = identify(docs, docs).filter("lang_pred <> 'und'")
    return _only(found.withColumn("lang", F.col("lang_pred")), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occurred before; those of which no word is left go."""
    found = dedup_lines(docs)
    emptied = (F.size("removed_spans") > 0) & ~F.col("clean_text").rlike(WORD)
    return _with_text(found.filter(~emptied), docs.columns, "clean_text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return _only(keep_one_of_each(docs), docs.columns)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by test items; the passages a kept one shares with items are cut out."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _with_text(found.filter(~F.col("contaminated")), docs.columns, "clean_text")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    back = encode_texts(docs, PIECE_MODEL, decoded="decoded")
    back = back.withColumn("round_trip", F.col("decoded").eqNullSafe(F.col("text")))
    return back.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark_text),
    ("sentencepiece", encode),
]

#: A trained network and a tokenizer are beyond SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table ``documents`` of ``sf_dir``, each on all that the one before kept.

    Documents with a null or empty text, or without a letter, go in the first stage. Rows with equal id and text are one
    document to line dedup and leave one row in the near-copy stage; so do equal texts under several ids, under the least.
    A null id stays a document of its own and comes last where ids are ordered. Very long texts are read whole. Further
    columns go through all stages but the last, unless an operator uses their names on the way. An empty table gives an
    empty one.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, written(stage(spark, docs, sf_dir), f"stage-{name}")
        if k:  # no later plan reads what the stage before has written
            drop_written(before)
    return docs
