"""Every operator on tables with odd columns, null rows, repeated rows and no rows."""

import os

import pytest
from pyspark.sql import functions as F

from receiptflow.llm.decontaminate import decontaminate
from receiptflow.llm.html_text import extract_text
from receiptflow.llm.jaccard_join import jaccard_groups, keep_one_of_each
from receiptflow.llm.language_id import identify
from receiptflow.llm.line_dedup import dedup_lines
from receiptflow.llm.quality_classifier import classify_quality
from receiptflow.llm.quality_rules import judge_quality
from receiptflow.llm.sentencepiece_codec import encode_texts
from receiptflow.llm.sharding import shard_documents
from receiptflow.llm.url_filter import Rule, filter_urls
from receiptflow.llm.warc import archive_pages

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
LONG = "long words of a text, " * 20_000
ROWS = [(1, "One text here.", "x"), (1, "One text here.", "x"), (None, "no id", None), (2, None, None), (3, "", "y"), (None, None, None), (4, LONG, "z"), (5, "€ ½ 日本", "q")]


def labels(spark, docs):
    return docs.select("doc_id", F.lit(1).alias("quality")).limit(3)


OPERATORS = {
    "line_dedup": lambda spark, t: dedup_lines(t),
    "html_text": lambda spark, t: extract_text(t, "text", "out"),
    "url_filter": lambda spark, t: filter_urls(t, [Rule("block", "a", "/")], "text"),
    "decontaminate": lambda spark, t: decontaminate(t, t.select(F.col("doc_id").alias("item_id"), "text").filter("doc_id < 4")),
    "jaccard_groups": lambda spark, t: jaccard_groups(t),
    "language_id": lambda spark, t: identify(t, t.select("text", F.col("`a.b`").alias("lang"))),
    "quality_classifier": lambda spark, t: classify_quality(t, labels(spark, t), F.col("`a.b`"), F.col("`a.b`")),
    "quality_rules": lambda spark, t: judge_quality(t),
    "sentencepiece": lambda spark, t: encode_texts(t, MODEL, decoded="again"),
    "warc": lambda spark, t: archive_pages(t.withColumn("url", F.lit("u")), "doc_id", "url", "text"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_comes_back(spark, name):
    if name == "sentencepiece" and not os.path.exists(MODEL):
        pytest.skip("the public tokenizer file is not here")
    table = spark.createDataFrame(ROWS, "doc_id long, text string, `a.b` string")
    odd = table.selectExpr("*", "1 AS id", "2 AS key", "3 AS __text", "4 AS hash", "5 AS `c.d`", "6 AS pos", "array(1) AS b")
    out = OPERATORS[name](spark, odd)
    kept = out.collect()
    assert len(kept) == len(ROWS)
    if name not in ("jaccard_groups", "warc"):
        assert {"a.b", "c.d", "id"} <= set(out.columns)
    once = [tuple(r) for r in kept if (r.page_id if name == "warc" else r.doc_id) == 1]
    assert len(once) == 2 and (name == "warc" or once[0] == once[1])
    assert OPERATORS[name](spark, odd.limit(0)).count() == 0


def test_near_copies_on_the_same_table(spark):
    table = spark.createDataFrame(ROWS, "doc_id long, text string, `a.b` string").selectExpr("*", "1 AS key")
    kept = keep_one_of_each(table).collect()
    # of the two equal rows one goes; the texts without words all stay
    assert len(kept) == len(ROWS) - 1 and keep_one_of_each(table.limit(0)).count() == 0


#: Names that operators have, or have had, for columns of their own.
INNER = (
    "__spans __items __spans0 __items0 __h __th __id __lines __bytes __host __path __t __p __label __said __hash __buckets __values __own __site_n "
    "id th pos h h2 words start past at y n s mean unit alone bytes part place cell f_length f_lines stats head role turn"
).split()


@pytest.mark.parametrize("name", ["line_dedup", "html_text", "url_filter", "decontaminate", "language_id", "quality_classifier", "sentencepiece", "sharding"])
def test_columns_named_like_inner_ones_come_along(spark, name):
    if name == "sentencepiece" and not os.path.exists(MODEL):
        pytest.skip("the public tokenizer file is not here")
    table = spark.createDataFrame(ROWS, "doc_id long, text string, `a.b` string")
    odd = table.selectExpr("*", *[f"'{c}' AS `{c}`" for c in INNER])
    run = OPERATORS[name] if name in OPERATORS else lambda spark, t: shard_documents(t, 3)
    rows = run(spark, odd).collect()
    assert len(rows) == len(ROWS) and all(r[c] == c for r in rows for c in INNER)
