"""Quality by hierarchical empirical Bayes: a document classifier's evidence on top of what is known of its site.

A logistic regression on hashed words and measures of the text, trained here, gives each document a likelihood ratio. Hosts and paths get
Beta posteriors from grouped sums over all their documents: a path's prior is its host, a host's prior is the whole
table, and how strongly a sparse site is drawn to its prior is estimated from how much sites differ.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.llm.shared import add_columns, quoted, without, written
from receiptflow.llm.words import split_words

_SPACE = r"[\x20\x09-\x0D]+"
FEATURES = ("f_length", "f_symbols", "f_bars", "f_digits", "f_upper", "f_word", "f_distinct", "f_long", "f_ends", "f_lines")


def features(text: Column, words: Column) -> dict[str, Column]:
    """Measures of a text as doubles of moderate size; a text without words has zeros."""
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return {
        "f_length": F.log1p(F.size(words).cast("double")),
        "f_symbols": F.least(F.lit(4.0), count(r"[#*$%&<>@\\^~{}\[\]]") / n),
        "f_bars": F.least(F.lit(2.0), count(r"[|=_]") / n),
        "f_digits": F.least(F.lit(2.0), count("[0-9]") / n),
        "f_upper": count("[A-Z]") / chars * 10,
        "f_word": F.least(F.lit(20.0), chars / n) / 5,
        "f_distinct": F.size(F.array_distinct(words)).cast("double") / n,
        "f_long": F.size(F.filter(words, lambda w: F.length(w) > 15)).cast("double") / n,
        "f_ends": F.least(F.lit(1.0), count(r"[.!?]") * 10 / n),
        "f_lines": F.least(F.lit(3.0), count("\n") * 10 / n),
    }


#: Words are hashed to so many numbers.
BUCKETS = 1 << 12
_COUNTS = [T.StructField("__buckets", T.ArrayType(T.IntegerType())), T.StructField("__values", T.ArrayType(T.FloatType()))]


def word_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the words of texts: the logarithm of one more than their count, of length 1 for each row."""
    words = split_words(column)
    row = np.repeat(np.arange(len(column)), words.counts())
    bucket = (words.hashes() >> np.uint64(64 - 12)).astype(np.int64)
    key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    row, bucket, value = key // BUCKETS, key % BUCKETS, np.log1p(count)
    norm = np.sqrt(np.bincount(row, value * value, len(column)))
    return row, bucket, value / norm[row]


def _with_values(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the buckets and values of each text's words."""

    def make():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            row, bucket, value = word_values(batch.column(batch.schema.get_field_index(text_col)))
            offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = (pa.array(bucket.astype(np.int32)), pa.array(value.astype(np.float32)))
            return [pa.ListArray.from_arrays(offsets, x) for x in lists]

        return compute

    return add_columns(docs, _COUNTS, make, weigh=text_col)


def _with_score(docs: DataFrame, text_col: str, name: str, weights: np.ndarray) -> DataFrame:
    """``docs`` with what the words of each text add to its log odds."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        w = shared.value

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            row, bucket, value = word_values(batch.column(batch.schema.get_field_index(text_col)))
            return [pa.array(np.bincount(row, value * w[bucket], batch.num_rows), pa.float64())]

        return compute

    return add_columns(docs, [T.StructField(name, T.DoubleType())], make, weigh=text_col)


@dataclass(frozen=True)
class Logistic:
    center: list[float]
    scale: list[float]
    weights: list[float]
    words: np.ndarray  # of the buckets
    bias: float
    base: float  # log odds of good among the rows it was fitted on

    def log_odds(self, names: tuple[str, ...], of_words: str) -> Column:
        out = F.lit(self.bias) + F.col(of_words)
        for n, c, s, w in zip(names, self.center, self.scale, self.weights, strict=True):
            out = out + (F.col(n) - F.lit(c)) * F.lit(w / s)
        return F.greatest(F.lit(-30.0), F.least(F.lit(30.0), out))


def fit_logistic(
    x: np.ndarray, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 300
) -> Logistic:
    """Logistic regression on measures ``x`` and words (row, bucket, value), with a ridge, by Adam over all rows at once.

    Without rows of both kinds it is a constant.
    """
    n, k = x.shape
    share = float(np.clip((y.sum() + 1) / (n + 2), 0.01, 0.99))
    base = float(np.log(share / (1 - share)))
    w = np.zeros(k + BUCKETS + 1)
    w[-1] = base
    if n == 0 or y.min() == y.max():
        return Logistic([0.0] * k, [1.0] * k, [0.0] * k, w[k:-1], base, base)
    center, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (x - center) / scale
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        odds = z @ w[:k] + np.bincount(row, value * w[k:-1][bucket], n) + w[-1]
        off = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y
        g = np.concatenate([z.T @ off, np.bincount(bucket, value * off[row], BUCKETS), [off.sum()]])
        g[:-1] += ridge * w[:-1]
        g /= n
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        w -= 0.3 * (1 - t / rounds) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)
    return Logistic(center.tolist(), scale.tolist(), w[:k].tolist(), w[k:-1], float(w[-1]), base)


def _strength(mean: float, between: float) -> float:
    """How many documents a prior is worth, from the variance of true means around it."""
    return min(10_000.0, max(1.0, mean * (1 - mean) / max(between, 1e-6) - 1))


def site_posteriors(rows: DataFrame) -> DataFrame:
    """(host, path, y) as (host, path, n, s, host_n, host_s, host_mean, host_kappa, path_kappa).

    Sums by path, sums of those by host, and four numbers of the whole table; the between-site variances are moment
    estimates. Every sum is partially aggregated, so a host with a third of all rows is as cheap as any.
    """
    paths = written(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")), "sites")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    hosts = written(hosts, "hosts")
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s"), F.count(F.lit(1)).alias("k")).first()
    n = float(total.n or 0)
    mean = min(0.999, max(0.001, (float(total.s or 0) + 1) / (n + 2)))
    spread = hosts.agg(
        F.sum(F.col("host_n") * F.pow(F.col("host_s") / F.col("host_n") - mean, 2)).alias("q"), F.sum(F.col("host_n") * F.col("host_n")).alias("nn")
    ).first()
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).select(paths["host"], "path", "n", "s", "host_n", "host_s")
    inner = both.agg(
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("host_s") / F.col("host_n"), 2)).alias("q"),
        F.sum(F.col("n") * F.col("n") / F.col("host_n")).alias("nn"),
        F.count(F.lit(1)).alias("k"),
    ).first()
    noise = mean * (1 - mean)

    def between(q, free: float, room: float) -> float:
        return max(0.0, (float(q or 0) - free * noise) / room) if room > 1e-9 else 0.0

    host_kappa = _strength(mean, between(spread.q, float(total.k) - 1, n - float(spread.nn or 0) / n) if n else 0.0)
    path_kappa = _strength(mean, between(inner.q, float(inner.k - total.k), n - float(inner.nn or 0)) if n else 0.0)
    return both.withColumns({"mean": F.lit(mean), "host_kappa": F.lit(host_kappa), "path_kappa": F.lit(path_kappa)})


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
    train_rows: int = 5_000,
    at_least: float = 0.5,
) -> DataFrame:
    """A row for each row of ``docs``: its columns without the text, ``p_text``, ``host_prior``, ``path_prior``, ``p_good``, ``kept``.

    ``labels`` has 0 or 1 for some ids; an id with several has their mean, rounded, and null labels are left out. The
    classifier is fitted on at most ``train_rows`` different labelled texts, picked by their hash. For its site a document counts by its
    label or, without one, by the classifier's probability; its own count is left out of the priors it gets itself.
    ``p_good`` joins the odds of the path's prior and the classifier's likelihood ratio; ``kept`` is ``p_good`` of
    ``at_least`` or more, so a tie is kept.

    A null or empty text has measures of zero and no words; a very long one is read whole, in linear time; null hosts and paths are sites of their own; repeated rows count
    each; without labels the classifier says one half of everything; an empty table gives an empty one; input columns
    named like outputs are replaced.
    """
    outputs = ["host", "path", "p_text", "host_prior", "path_prior", "p_good", "kept"]
    given = labels.filter(F.col(label_col).isNotNull() & F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("__id"))
    given = written(given.agg(F.round(F.avg(F.col(label_col).cast("double"))).alias("__label")), "quality-labels")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    measures = lambda df: df.withColumn("__words", F.filter(F.split("__text", _SPACE), lambda w: w != "")).withColumns(
        features(F.col("__text"), F.col("__words"))
    ).drop("__words")
    # the sample: measures and words of labelled rows below a hash, then the first of these by hash
    labelled = docs.select(F.col(id_col).alias("__id"), text.alias("__text")).join(given, "__id").withColumn("__hash", F.xxhash64("__text"))
    share = min(1.0, 2.0 * train_rows / max(1, given.count()))
    picked = labelled.filter(F.pmod("__hash", F.lit(1_000_003)) < share * 1_000_003)
    # a text that many rows repeat is one of the sample, or two if their labels differ
    picked = measures(picked.dropDuplicates(["__hash", "__label"]))
    sample = _with_values(picked, "__text").drop("__text", "__id").orderBy("__hash", "__label").limit(train_rows).toArrow().combine_chunks()
    x = np.column_stack([sample.column(f).to_numpy() for f in FEATURES])
    sizes = sample.column("__buckets").combine_chunks().value_lengths().to_numpy()
    flat = [sample.column(c).combine_chunks().flatten().to_numpy() for c in ("__buckets", "__values")]
    model = fit_logistic(x, np.repeat(np.arange(len(sizes)), sizes), *flat, sample.column("__label").to_numpy())
    # the caller's columns go along under plain names, which clash with none of those used on the way
    along = without(docs, [text_col, *outputs]).columns
    back = {f"c{i}": c for i, c in enumerate(along)}
    own = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(along)]
    table = docs.select(*own, host.alias("host"), path.alias("path"), text.alias("__text"), F.col(quoted(id_col)).alias("__own"))
    odds = model.log_odds(FEATURES, "__said")
    table = measures(_with_score(table, "__text", "__said", model.words)).drop("__text")
    table = table.withColumn("__evidence", odds - F.lit(model.base)).withColumn("p_text", 1 / (1 + F.exp(-odds)))
    table = table.drop(*FEATURES, "__said").join(given, F.col("__own") == F.col("__id"), "left").drop("__id", "__own")
    table = written(table, "quality-evidence")
    table = table.withColumn("y", F.coalesce("__label", "p_text"))
    sites = site_posteriors(table)
    sites = sites.withColumnsRenamed({c: f"__site_{c}" for c in sites.columns})
    site = lambda c: F.col(f"__site_{c}")
    out = table.join(sites, F.col("host").eqNullSafe(site("host")) & F.col("path").eqNullSafe(site("path")))
    host_prior = (site("host_s") - F.col("y") + site("host_kappa") * site("mean")) / (site("host_n") - 1 + site("host_kappa"))
    path_prior = (site("s") - F.col("y") + site("path_kappa") * F.col("host_prior")) / (site("n") - 1 + site("path_kappa"))
    bounded = lambda c: F.least(F.lit(0.999), F.greatest(F.lit(0.001), c))
    out = out.withColumn("host_prior", bounded(host_prior)).withColumn("path_prior", bounded(path_prior))
    out = out.withColumn("p_good", 1 / (1 + F.exp(-(F.col("__evidence") + _odds(F.col("path_prior"))))))
    out = out.withColumn("kept", F.col("p_good") >= at_least)
    return out.select(*[F.col(k).alias(c) for k, c in back.items()], *outputs)
