"""The similarity join against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from receiptflow.llm import jaccard_join
from receiptflow.llm.jaccard_join import components, jaccard_groups, keep_one_of_each, recall_of, runs_for
from tests.llm.sql import equals_sql

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words(text):
    return tuple(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def grams(w):
    return {w[i : i + 5] for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    nodes = sorted({words(t) for _, t in rows} - {()})
    sets = {w: grams(w) for w in nodes}
    links, root = Counter(), {w: w for w in nodes}

    def find(w):
        while root[w] != w:
            w = root[w]
        return w

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            both = len(sets[a] & sets[b])
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    classes = {w: find(w) for w in nodes}
    least = {}
    for k, t in rows:
        if words(t) and k is not None:
            c = classes[words(t)]
            least[c] = min(k, least.get(c, k))
    return classes, least, links


def corpus(seed, families, size, length=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    out = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.randint(length, 2 * length))
        for _ in range(rng.randint(1, size)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            out.append(" ".join(text))
    rng.shuffle(out)
    return out


def check(spark, rows):
    classes, least, links = brute(rows)
    copies = Counter(words(t) for _, t in rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS KEY", "1 AS bucket")
    texts = table.selectExpr("doc_id AS d", "text").distinct()
    got = jaccard_groups(table.withColumn("t2", table.text), text_col="t2").join(texts, F.expr("doc_id <=> d"))
    by_words = {}
    for r in got.collect():
        w = words(r.text)
        if bytes(r.key or b"") == b"":
            assert (r.class_id, r.n_links, r.n_copies, r.kept) == (r.doc_id, 0, 1, True)
            continue
        if w and copies[w] and by_words.setdefault(w, r.key) == r.key:
            assert r.n_links == links[w] and r.n_copies == copies[w] and r.class_id == least.get(classes[w])
    assert len(jaccard_groups(table).collect()) == len(rows)


def test_recall_of_the_scheme():
    """The computed chance against a simulation of pairs walking down the tree."""
    assert runs_for(0.8, 0.9995) == 4
    rng = np.random.default_rng(5)
    for runs in (2, 4):
        width = 2 * runs
        levels = jaccard_join.COORDINATES // width
        missed, pairs = 0, 3000
        for _ in range(pairs):
            paths = (rng.random(width) < 0.8).sum()
            for _ in range(levels - 1):
                agree = rng.random(width) < 0.8
                paths = sum(agree[rng.choice(width, 2, replace=False)].sum() for _ in range(min(paths, 12)))
            missed += paths == 0
        assert 1 - missed / pairs == pytest.approx(recall_of(0.8, runs), abs=4 * (0.01 / pairs) ** 0.5)


def test_texts_that_fool_polynomial_hashes(spark):
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    rows = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in jaccard_groups(rows).collect()} == {1: 1, 2: 2, 3: 1}


def test_small_cases(spark):
    a = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, "..."), (5, "one two"), (4, "One, two!"), (6, "one two three"), (9, a), (8, a + " more"), (7, a + " more"), (10, a.upper())]
    check(spark, rows)
    empty = jaccard_groups(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0 and keep_one_of_each(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_random_corpus_has_every_link(spark):
    check(spark, list(enumerate(corpus(11, 60, 8))))


def test_split_buckets_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL", 12)
    check(spark, list(enumerate(corpus(12, 6, 90, 40))))
    # one line shared by all: large buckets of unlike texts, which the tree has to split
    line = " ".join(f"s{i}" for i in range(12))
    check(spark, [(k, line + " " + t) for k, t in enumerate(corpus(13, 90, 2, 12))])


@pytest.mark.parametrize("cell", [12, 400])
def test_cells_of_many_grams_are_cut(spark, monkeypatch, cell):
    """Cells within a block and across two, cut into parts of a few texts each: no link is lost or counted twice."""
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    monkeypatch.setattr(jaccard_join, "CELL_GRAMS", 300)
    check(spark, list(enumerate(corpus(15, 5, 70, 40))))
    rows = [(i, low, high, side, b"%d" % i, parts) for i, (low, high, side, parts) in enumerate([(0, 0, 0, 3)] * 9 + [(0, 1, 0, 4)] * 8 + [(0, 1, 1, 4)] * 8 + [(1, 1, 1, 1)] * 3)]
    cells = spark.createDataFrame(rows, "i long, low int, high int, side int, key binary, parts long").selectExpr("*", "7L AS bucket", "array(7L) AS buckets")
    met = Counter()
    found = {}
    for r in jaccard_join._smaller_cells(cells).collect():
        found.setdefault((r.low, r.high), []).append((int(bytes(r.key)), r.side))
    for (low, high), own in found.items():
        met.update((a, b) for a, x in own for b, y in own if a < b and (low == high or x != y))
    expected = {(a, b) for a in range(9) for b in range(9) if a < b} | {(a, b) for a in range(9, 17) for b in range(17, 25)} | {(25, 26), (25, 27), (26, 27)}
    assert set(met) == expected and set(met.values()) == {1}


def test_repeated_rows_of_one_id_bring_one_set(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text)] * 300 + [(2, text + " more")] * 3 + [(1, "other words that are on the same id")] * 2
    got = {(r.doc_id, r.n_links, r.n_copies, r.class_id) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1, 300, 1), (2, 1, 3, 1), (1, 0, 2, 1)}


def test_keeps_one_row_of_each_class(spark):
    rng = random.Random(2)
    texts = corpus(14, 20, 6)
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(3, texts[3], "y"), (3, "other words entirely in this one", "z"), (None, texts[5], "n")]
    rows += [(900, None, "a"), (901, "", "b"), (None, "lonely words without any id at all", "c"), (None, "lonely words without any id at all", "d")]
    rng.shuffle(rows)
    kept = keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, __key string")).collect()
    classes, least, _ = brute([(k, t) for k, t, _ in rows])
    found = Counter(classes[words(r.text)] for r in kept if words(r.text))
    assert set(found.values()) == {1} and len(found) == len(set(classes.values()))
    assert all(r.doc_id == least.get(classes[words(r.text)]) for r in kept if words(r.text))
    assert sum(not words(r.text) for r in kept) == 2


@pytest.mark.parametrize("n", [1, 2, 50])
def test_components_of_chains(spark, n):
    edges = [(b"a%03d" % i, b"a%03d" % (i + 1)) for i in range(n)] + [(b"z1", b"z0"), (b"z0", b"z0")]
    got = {bytes(r.key): bytes(r.label) for r in components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert got == {**{b"a%03d" % i: b"a000" for i in range(n + 1)}, b"z0": b"z0", b"z1": b"z0"}


def test_rows_of_one_id_and_words_have_an_order(spark):
    rows = [(1, "some words of a text here", x, {"k": x}) for x in ("b", "a", "c")] + [(2, "Some words, of a text here", "d", None)]
    schema = "doc_id long, text string, `x.y` string, m map<string,string>"
    seen = {keep_one_of_each(spark.createDataFrame(rows[::k], schema).repartition(n)).collect()[0][2] for k in (1, -1) for n in (1, 3)}
    assert len(seen) == 1


def test_every_link_of_the_tables(spark):
    """The query against its SQL, which compares all pairs that share a run of five words."""
    equals_sql(spark, "op5_jaccard_join", "/root/testdata/sf0.01")
