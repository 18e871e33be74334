"""Line dedup against a look at all runs of lines."""

import random
import re

from receiptflow.llm.line_dedup import dedup_lines
from tests.llm.sql import equals_sql

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def brute(texts, least):
    """texts: unique documents in order. The line numbers that go from each."""
    first, gone = {}, []
    for d, text in enumerate(texts):
        lines = [(i, x.strip(" "), len(WORD.findall(x))) for i, x in enumerate((text or "").split("\n"))]
        full = [x for x in lines if x[2]]
        cut = set()
        for s in range(len(full)):
            words, run = 0, []
            for e in range(s, len(full)):
                words += full[e][2]
                run.append(full[e][1])
                if words >= least:
                    place = first.setdefault(tuple(run), (d, s))
                    if place != (d, s):
                        cut.update(range(full[s][0], full[e][0] + 1))
        gone.append(cut)
    return gone


def check(spark, texts, least):
    rows = list(enumerate(texts))
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS pos", "2 AS Spans", "3 AS ID")
    got = {r.doc_id: r for r in dedup_lines(table, least_words=least).collect()}
    assert len(got) == len(texts)
    for k, (text, cut) in enumerate(zip(texts, brute(texts, least), strict=True)):
        lines = (text or "").split("\n")
        want = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in cut)
        assert got[k].clean_text == want, (k, text, cut)
        assert {i for s in got[k].removed_spans for i in range(s.first, s.last + 1)} == cut


def test_random_lines_against_all_runs(spark):
    rng = random.Random(7)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.choice([1, 2, 3, 6, 12]))) for _ in range(14)] + ["", "  ", " \t"]
    for least in (5, 9):
        texts = ["\n".join(rng.choices(pool, k=rng.randint(0, 9))) for _ in range(60)] + [None, "", "\n\n", "a\n" * 30]
        check(spark, texts, least)


def test_long_single_lines_and_tails(spark):
    line = " ".join(f"w{i}" for i in range(60))
    tail = "just ten words " * 3 + "x"
    texts = [line + "\n" + tail + "\nend one", "start\n" + line + "\n\n" + tail + "\nother", tail, line, "  " + line + " ", "p\n" + line[:-1]]
    check(spark, texts, 50)


def test_repeated_rows_null_ids_and_empty(spark):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(2, line), (2, line), (None, line), (None, line), (1, "own\n" + line), (1, "q\n" + line), (5, line[::-1])]
    got = [(r.doc_id, r.text, r.clean_text) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(x[2] for x in got if x[1] == line) == ["", "", "", ""]
    ones = sorted(x[2] for x in got if x[0] == 1)
    assert ones in (["own", "q\n" + line], ["own\n" + line, "q"])
    assert [x[2] for x in got if x[0] == 5] == [line[::-1]]
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_very_long_texts_and_hot_lines(spark):
    """A line in every document, a text of many lines met twice, and one endless line."""
    hot = " ".join(f"h{i}" for i in range(55))
    long = "\n".join(f"line {i} " + "w " * 6 for i in range(4000))
    texts = [hot + f"\nown {k}" for k in range(300)] + ["x " * 200_000, "start\n" + long, long + "\nend", "y" * 500_000]
    got = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0].clean_text == texts[0] and all(got[k].clean_text == f"own {k}" for k in range(1, 300))
    assert [len(got[k].clean_text) for k in (300, 301, 302, 303)] == [400_000, len(texts[301]), 3, 500_000]


def test_op1_query_equals_its_sql(spark):
    equals_sql(spark, "op1_line_dedup", "/root/testdata/sf0.001")
