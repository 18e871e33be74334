"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from receiptflow.llm import lexical_search
from receiptflow.llm.lexical_search import Postings, Top, search
from tests.llm.sql import equals_sql

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in TERM.findall(text or "")]


def brute(docs, items, k):
    counted = [(d, Counter(terms(x))) for d, x in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for d, c in counted:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // total
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, rank + 1, None if n else d, -s) for rank, (s, n, d) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def made(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.mark.parametrize("k", [3, 50])
def test_random_texts_against_all_scores(spark, monkeypatch, k):
    monkeypatch.setattr(lexical_search, "_DOCS", 64)
    rng = random.Random(k)
    words = [f"{rng.choice(['Re', 'é', 'x9', '日本'])}{i}" for i in range(60)] + ["the"] * 40 + ["a_b", "A.B", "ﬁ"]
    docs = [(i, made(rng, rng.choice([1, 5, 30, 200]), words)) for i in range(500)]
    docs += [(None, docs[3][1]), (None, None), (7, ""), (8, "... !"), docs[5], docs[5], (9000, docs[5][1])]
    items = [(i, made(rng, rng.choice([1, 4, 30]), words)) for i in range(25)] + [(1, "the"), (2, None), (3, "?"), (None, "the x9"), (30, "unknown")]
    items += items[:3]
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS item", "3 AS terms", "4 AS `a.b`").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS t", "2 AS query", "3 AS id")
    for block in (1 << 20, 300):
        got = Counter(tuple(r) for r in search(table, asked, k, block_bytes=block).collect())
        assert got == brute(docs, items, k)
    assert search(table.limit(0), asked, k).count() == search(table, asked.limit(0), k).count() == 0


def test_most_documents_are_never_scored():
    rng = np.random.default_rng(1)
    n = 4000
    docs, lists = np.nonzero(rng.random((n, 12)) < np.linspace(0.005, 0.5, 12))
    impacts = rng.integers(1, 1000, len(docs)) * np.linspace(40, 1, 12).astype(np.int64)[lists]
    found, top = Postings(docs, lists, impacts, n), Top(10)
    top.names = np.arange(n)
    scored = []
    add = top.add
    top.add = lambda s, d: (scored.extend(d.tolist()), add(s, d))
    found.search(np.arange(12), top)
    want = np.bincount(docs, impacts, n).astype(np.int64)
    assert top.scores.tolist() == sorted(want.tolist(), reverse=True)[:10]
    assert len(scored) == len(set(scored)) < n / 2


def test_a_very_long_text(spark):
    docs = [(1, "needle " + "hay " * 400_000), (2, "needle"), (3, "x" * 2_000_000)]
    got = search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, "Needle")], "item_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute(docs, [(1, "Needle")], 50)


def test_op11_query_equals_its_sql(spark):
    equals_sql(spark, "op11_lexical_search", "/root/testdata/sf0.001")
