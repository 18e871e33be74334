"""The corpus pipeline, each stage on its own input against a plain restatement, and as a whole."""

import random
import re

import pytest

import corpus_pipeline
from receiptflow.llm.shared import written
from tests.llm.test_jaccard_join import brute as brute_groups
from tests.llm.test_jaccard_join import words
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_rowwise import brute_hits

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghijklm", k=rng.randint(2, 7))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    texts = [None, "", "123 ?!", "one"]
    passage = prose(60)
    texts += [prose(rng.randint(20, 200)) for _ in range(40)]
    texts += [prose(30) + "\n" + passage + "\n" + prose(30) for _ in range(5)]
    near = prose(120).split()
    for _ in range(6):
        near[rng.randrange(120)] = rng.choice(vocabulary)
        texts.append(" ".join(near))
    items = [(k, prose(40)) for k in range(6)]
    texts += [prose(30) + " " + items[1][1], prose(900) + " " + " ".join(items[2][1].split()[:15]) + " " + prose(9)]
    texts += [texts[10], texts[10]]
    rows = [(k, t, rng.choice(["xx", "yy"]), "src1", len(t or "")) for k, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_on_its_input(spark, folder):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = sorted(docs.collect(), key=lambda r: r.doc_id)
        docs = written(stage(spark, docs, folder), "test-stage")
        assert docs.columns == [x.split()[0] for x in SCHEMA.split(", ")]
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "language_id":
            want = {r.doc_id: r.text for r in before if r.text and re.search("[a-z]", r.text)}
        elif name == "line_dedup":
            want = {}
            for r, cut in zip(before, brute_lines([r.text for r in before], 50), strict=True):
                text = "\n".join(x for i, x in enumerate(r.text.split("\n")) if i not in cut)
                if text.strip() or not cut:
                    want[r.doc_id] = text
        elif name == "jaccard_join":
            classes, least, _ = brute_groups([(r.doc_id, r.text) for r in before])
            want = {r.doc_id: r.text for r in before if not words(r.text) or least[classes[words(r.text)]] == r.doc_id}
        else:
            kept = {}
            for r in before:
                all_words, hit, _ = brute_hits(r.text, items, 13)
                if not hit or 20 * len(hit) < len(all_words):
                    kept[r.doc_id] = [w for i, w in enumerate(all_words) if i not in hit]
            assert {k: list(words(t)) for k, t in after.items()} == kept
            want = after
        assert after == want, name
        assert len(after) < len(before)
        assert all(r.n_chars == len(r.text) for r in docs.filter("text IS NOT NULL").collect())


def test_run_and_empty(spark, folder, tmp_path):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert len(rows) == len({r.doc_id for r in rows}) > 30 and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_and_columns(spark, tmp_path):
    """Null ids and texts, repeated rows, equal texts under two ids, a very long text, columns named like inner ones."""
    long = " ".join(f"word{i} of a long text" for i in range(20_000))
    rows = [(1, "One text of some words here."), (1, "One text of some words here."), (2, "one text, of some words here"), (None, "A text without any id."), (3, None), (4, "12 34"), (5, long)]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "1L AS n_chars", "1 AS __key", "2 AS `a.b`", "3 AS ids")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "unlike anything")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = written(stage(spark, docs, str(tmp_path)), "test-odd")
        assert docs.columns == table.columns
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 22), (1, 28), (5, len(long))] and all(r.round_trip for r in got)
