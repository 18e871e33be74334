"""The hierarchical quality classifier: its sums against plain Python, its accuracy on planted texts, edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from receiptflow.llm.queries import op8_quality_classifier
from receiptflow.llm.quality_classifier import _strength, classify_quality, fit_logistic, site_posteriors, word_values
from receiptflow.llm.words import split_words


def brute_sites(rows):
    paths, hosts = {}, {}
    for h, p, y in rows:
        n, s = paths.get((h, p), (0, 0.0))
        paths[h, p] = n + 1, s + y
        n, s = hosts.get(h, (0, 0.0))
        hosts[h] = n + 1, s + y
    n = len(rows)
    mean = min(0.999, max(0.001, (sum(y for *_, y in rows) + 1) / (n + 2)))
    noise = mean * (1 - mean)
    q = sum(c * (s / c - mean) ** 2 for c, s in hosts.values())
    host_var = max(0.0, (q - (len(hosts) - 1) * noise) / (n - sum(c * c for c, _ in hosts.values()) / n))
    q = sum(c * (s / c - hosts[h][1] / hosts[h][0]) ** 2 for (h, _), (c, s) in paths.items())
    room = n - sum(c * c / hosts[h][0] for (h, _), (c, _) in paths.items())
    path_var = max(0.0, (q - (len(paths) - len(hosts)) * noise) / room)
    return paths, hosts, mean, _strength(mean, host_var), _strength(mean, path_var)


def test_site_sums(spark):
    rng = random.Random(1)
    rows = []
    for h in ["a", "b", "c", None, ""]:
        for p in ["x", "y", None]:
            good = rng.random()
            rows += [(h, p, float(rng.random() < good)) for _ in range(rng.randint(1, 30))]
    paths, hosts, mean, kh, kp = brute_sites(rows)
    got = site_posteriors(spark.createDataFrame(rows, "host string, path string, y double")).collect()
    assert len(got) == len(paths)
    for r in got:
        assert (r.n, r.s, r.host_n, r.host_s) == pytest.approx((*paths[r.host, r.path], *hosts[r.host]))
        assert (r["mean"], r.host_kappa, r.path_kappa) == pytest.approx((mean, kh, kp))


NONE = np.zeros(0, int)


def test_logistic_separates_and_survives_one_class():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(float)
    m = fit_logistic(x, NONE, NONE, NONE, y)
    assert m.weights[0] > 1 and abs(m.weights[1]) < 0.5
    for n in (0, 5):
        m = fit_logistic(np.ones((n, 2)), NONE, NONE, NONE, np.ones(n))
        assert m.weights == [0.0, 0.0] and m.bias == m.base
    # words alone: bucket 7 is bad, bucket 9 is good
    row = np.arange(200)
    y = (row % 2).astype(float)
    m = fit_logistic(np.zeros((200, 1)), row, np.where(row % 2, 9, 7), np.ones(200), y)
    assert m.words[9] > 1 and m.words[7] < -1 and not m.words[:7].any()


def test_word_values():
    texts = ["One two TWO, two", None, "", "x"]
    row, bucket, value = word_values(pa.array(texts))
    names = dict(zip(["one", "two", "x"], (split_words(pa.array(["one two x"])).hashes() >> np.uint64(52)).tolist(), strict=True))
    norm = (np.log(2) ** 2 + np.log(4) ** 2) ** 0.5
    want = {(0, names["one"]): np.log(2) / norm, (0, names["two"]): np.log(4) / norm, (3, names["x"]): 1.0}
    assert dict(zip(zip(row.tolist(), bucket.tolist(), strict=True), value.tolist(), strict=True)) == pytest.approx(want)


def test_words_decide_where_measures_do_not(spark):
    """Good and bad texts of one shape, told apart by their words."""
    rng = random.Random(4)
    kinds = [["alpha", "gamma", "delta", "sigma"], ["ketch", "sloop", "yacht", "barge"]]
    rows = [(k, " ".join(rng.choices(kinds[k % 2], k=30)), "h", "p", k % 2) for k in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, p string, quality int")
    got = classify_quality(table.drop("quality"), table.filter("doc_id < 100").select("doc_id", "quality"), F.col("source"), F.col("p")).collect()
    assert all(r.kept == bool(r.doc_id % 2) for r in got)


def test_priors_and_verdicts_restated(spark):
    """From ``p_text`` on, in plain Python: what a site says without the document itself, and the joined odds."""
    rows = corpus(120, 5) + [(-1, None, None, None, 1), (-2, "", "h1", None, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, p string, quality int")
    labels = table.filter("doc_id % 3 = 0").select("doc_id", "quality")
    got = classify_quality(table.drop("quality"), labels, F.col("source"), F.col("p")).collect()
    said = {r.doc_id: r.quality for r in labels.collect()}
    y = {r.doc_id: said.get(r.doc_id, r.p_text) for r in got}
    paths, hosts, mean, kh, kp = brute_sites([(r.host, r.path, y[r.doc_id]) for r in got])
    share = (sum(said.values()) + 1) / (len(said) + 2)
    bounded = lambda x: min(0.999, max(0.001, x))
    logit = lambda x: np.log(x / (1 - x))
    for r in got:
        n, s = hosts[r.host]
        host = bounded((s - y[r.doc_id] + kh * mean) / (n - 1 + kh))
        n, s = paths[r.host, r.path]
        path = bounded((s - y[r.doc_id] + kp * host) / (n - 1 + kp))
        good = 1 / (1 + np.exp(-(logit(r.p_text) - logit(share) + logit(path))))
        assert (r.host_prior, r.path_prior, r.p_good) == pytest.approx((host, path, good), abs=1e-6)
        assert r.kept == (r.p_good >= 0.5)


def corpus(n, seed=2):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(60)]
        text = " ".join(words) + "." if good else " ".join(w + rng.choice("#*$%") for w in words)
        rows.append((k, text, f"h{rng.randint(0, 5)}", "p", int(good)))
    return rows


def test_held_out_and_edges(spark):
    rows = corpus(300)
    edge = [(-1, None, None, None, 1), (-2, "", "h1", None, 0), (None, "abc", "", "q", 1), (5, rows[5][1], "h0", "p", 0), (-3, "w " * 100_000, "h2", "z", 1)]
    table = spark.createDataFrame(rows + edge, "doc_id long, text string, source string, p string, q int").selectExpr("*", "1 AS KEPT", "2 AS y", "3 AS n")
    labels = table.filter("doc_id % 2 = 0 AND doc_id >= 0").select("doc_id", F.col("q").alias("quality"))
    labels = labels.union(spark.createDataFrame([(4, None), (None, 1), (2, None)], labels.schema))
    got = classify_quality(table.drop("q"), labels, F.col("source"), F.col("p")).collect()
    assert len(got) == len(rows) + len(edge)
    good = {k: q for k, _, _, _, q in rows}
    held = [r for r in got if r.doc_id is not None and r.doc_id % 2 == 1 and r.doc_id > 5]
    assert sum(r.kept == bool(good[r.doc_id]) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.p_good <= 1 and r.kept == (r.p_good >= 0.5) and 0 < r.path_prior < 1 for r in got)


def test_a_hot_text_does_not_fill_the_sample(spark):
    tried = spark.createDataFrame([(f"hot text {k}",) for k in range(200)], "t string").withColumn("h", F.xxhash64("t"))
    (hot,) = tried.filter(F.pmod("h", F.lit(1_000_003)) < 400_000).orderBy("h").limit(1).collect()
    rows = corpus(200)
    copies = [(k, hot.t, "h1", "p", 1) for k in range(1000, 1200)]
    table = spark.createDataFrame(rows + copies, "doc_id long, text string, source string, p string, q int")
    labels = table.select("doc_id", F.col("q").alias("quality"))
    got = classify_quality(table.drop("q"), labels, F.lit("h"), F.lit("p"), train_rows=100).filter("doc_id < 1000").collect()
    good = {k: q for k, _, _, _, q in rows}
    assert len(got) == 200 and sum((r.p_text >= 0.5) == bool(good[r.doc_id]) for r in got) >= 190


def test_without_labels_or_rows(spark):
    table = spark.createDataFrame([(k, t, h, p) for k, t, h, p, _ in corpus(5)], "doc_id long, text string, h string, p string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {round(r.p_text, 6) for r in classify_quality(table, none, F.col("h"), F.col("p")).collect()} == {0.5}
    assert classify_quality(table.limit(0), none, F.col("h"), F.col("p")).count() == 0


def test_query_counts_every_label(spark, tmp_path):
    """Two texts alike on one site: what is said of the one moves the prior of the other, whatever its id hashes to."""
    rows = [(k, t, h, p) for k, t, h, p, _ in corpus(60)] + [(k, "the same text here", "site", "de") for k in range(100, 140)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    fold = [r.doc_id for r in spark.createDataFrame([(k,) for k in range(100, 140)], "doc_id long").filter("crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2").collect()]
    assert fold
    labels = [(k, g) for k, *_, g in corpus(60)]
    seen = []
    for quality in (0, 1):
        path = tmp_path / str(quality)
        path.mkdir()
        (path / "documents.parquet").symlink_to(tmp_path / "documents.parquet")
        spark.createDataFrame(labels + [(k, quality) for k in fold], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
        rows_of = op8_quality_classifier(spark, str(path)).filter("host = 'site'").collect()
        seen.append({r.doc_id: r.host_prior for r in rows_of})
    assert all(seen[0][k] < seen[1][k] for k in seen[0])


def test_held_out_labels_of_the_tables(spark):
    """A quarter of the given labels stays out, to measure by."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    found = classify_quality(docs, labels.filter(fold != 2), F.col("source"), F.concat_ws("/", "source", "lang"))
    held = found.join(labels.filter(fold == 2).select("doc_id", "quality"), "doc_id").collect()
    assert len(held) == 94 and sum(r.kept == bool(r.quality) for r in held) == 94
