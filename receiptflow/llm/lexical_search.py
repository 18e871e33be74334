"""Ranked lexical search: best-first document intervals, bounded by range maxima of posting lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from receiptflow.llm.shared import blocks, drop_written, quoted, written
from receiptflow.llm.words import Vocabulary, split_words
from receiptflow.session import ship_package

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Documents whose postings a task holds at a time, and intervals that it splits at a time.
_DOCS, _AT_ONCE = 4096, 64
#: Groups in which a query's candidates meet before they meet as one.
_SALTS = 64
_INT = np.int64


def term_weight(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))"""
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(_INT)


def length_norm(n_terms: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """100 - 50 + (50 n N) div L; where this would leave 64 bits on the way, by Python's integers."""
    if 50 * int(n_terms.max(initial=0)) * n_docs < 1 << 63:
        return 50 + 50 * n_terms * n_docs // max(all_terms, 1)
    return np.array([50 + 50 * int(n) * n_docs // all_terms for n in n_terms], _INT)


class Postings:
    """Posting lists of a block of documents with a sparse table of range maxima.

    Postings lie in the order of term and document. ``best[k][i]`` is the place of the greatest impact in
    ``[i, i + 2**k)``; a range inside a list is covered by two such, so its maximum costs two look-ups.
    """

    def __init__(self, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_docs: int):
        keys = terms * n_docs + docs
        order = np.argsort(keys)
        self.n_docs, self.keys, self.impacts = n_docs, keys[order], impacts[order]
        longest = int(np.unique(terms, return_counts=True)[1].max(initial=1))
        levels = [np.arange(len(keys), dtype=np.int32)]
        while 2 << (len(levels) - 1) <= longest:
            a, step = levels[-1], 1 << (len(levels) - 1)
            higher = a.copy()
            x, y = a[:-step], a[step:]
            higher[: len(x)] = np.where(self.impacts[x] >= self.impacts[y], x, y)
            levels.append(higher)
        self.best = np.stack(levels)
        self.log = np.zeros(longest + 2, np.int8)
        self.log[1:] = np.log2(np.arange(1, longest + 2)).astype(np.int8)

    def _bounded(self, low: np.ndarray, past: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum of the lists' maxima in each interval, and the document of the greatest."""
        size = past - low
        some = size > 0
        level = self.log[size]
        last = max(len(self.impacts) - 1, 0)
        x = self.best[level, np.minimum(low, last)]
        y = self.best[level, np.clip(past - (1 << level.astype(_INT)), 0, last)]
        u, v = self.impacts[x], self.impacts[y]
        most = np.where(some, np.maximum(u, v), -1)
        list_ = most.argmax(axis=1)[:, None]
        place = np.take_along_axis(np.where(u >= v, x, y), list_, 1)[:, 0]
        return np.where(some, most, 0).sum(axis=1), self.keys[place] % self.n_docs

    def search(self, terms: np.ndarray, top: Top) -> None:
        """Puts all documents into ``top`` that belong there.

        The intervals of greatest bound are split at the document with the greatest impact in one of their lists, which
        is scored; an interval whose bound is below the last score of a full ``top`` can hold nothing more. One with an equal bound can:
        ids decide between equal scores.
        """
        base = terms * self.n_docs
        low, past = np.searchsorted(self.keys, base)[None, :], np.searchsorted(self.keys, base + self.n_docs)[None, :]
        keep = (past > low)[0]
        low, past, base = low[:, keep], past[:, keep], base[keep]
        if not len(base):
            return
        bound, doc = self._bounded(low, past)
        while len(bound):
            open_ = bound >= max(top.least, 1)
            if not open_.all():
                low, past, bound, doc = low[open_], past[open_], bound[open_], doc[open_]
                if not len(bound):
                    return
            if len(bound) > _AT_ONCE:
                now = np.argpartition(-bound, _AT_ONCE)
                now, rest = now[:_AT_ONCE], now[_AT_ONCE:]
            else:
                now, rest = np.arange(len(bound)), np.zeros(0, _INT)
            here, start, end = doc[now], low[now], past[now]
            middle = np.searchsorted(self.keys, base + here[:, None])
            found = middle < end
            found[found] = self.keys[middle[found]] == (base + here[:, None])[found]
            scores = np.where(found, self.impacts[np.minimum(middle, len(self.impacts) - 1)], 0).sum(axis=1)
            top.add(scores, here)
            l = np.concatenate([start, middle + found])  # noqa: E741
            p = np.concatenate([middle, end])
            b, d = self._bounded(l, p)
            good = b >= max(top.least, 1)
            low, past = np.concatenate([low[rest], l[good]]), np.concatenate([past[rest], p[good]])
            bound, doc = np.concatenate([bound[rest], b[good]]), np.concatenate([doc[rest], d[good]])


class Top:
    """The best documents of one query so far: scores and ids, which are numbers in the order of the ids."""

    def __init__(self, k: int):
        self.k, self.least = k, 0
        self.scores, self.ids = np.zeros(0, _INT), np.zeros(0, _INT)
        self.names = np.zeros(0, _INT)  # ids of the block's documents

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        good = scores >= max(self.least, 1)
        if not good.any():
            return
        self.scores = np.concatenate([self.scores, scores[good]])
        self.ids = np.concatenate([self.ids, self.names[docs[good]]])
        if len(self.scores) >= self.k:
            order = np.lexsort((self.ids, -self.scores))[: self.k]
            self.scores, self.ids = self.scores[order], self.ids[order]
            self.least = int(self.scores[-1])


def item_terms(items: DataFrame, text_col: str) -> DataFrame:
    """(t, terms): the digest of each different text and its terms, once each."""
    texts = items.select(F.col(quoted(text_col)).cast("string").alias("text")).filter(F.col("text").rlike(_TERM))
    texts = texts.withColumn("t", F.sha2("text", 256)).dropDuplicates(["t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", 1 << 20):
                words = split_words(part.column("text"))
                found = [w.split(b" ") if w else [] for w in words.texts()]
                terms = [sorted({x.decode() for x in w}) for w in found]
                yield pa.RecordBatch.from_arrays([part.column("t"), pa.array(terms, pa.list_(pa.string()))], names=["t", "terms"])

    return texts.select("t", "text").mapInArrow(run, "t string, terms array<string>")


def _item_blocks(terms: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, list[str]]]]:
    block, size = [], 0
    for row in terms.toLocalIterator():
        block.append((row.t, list(row.terms)))
        size += 64 + sum(len(x.encode()) + 8 for x in row.terms)
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def index_terms(docs: DataFrame, vocabulary: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) of each document with a term: how many it has, which of the vocabulary, and how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    source = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in blocks(batch, "text", 1 << 22):
                words = split_words(part.column("text"))
                n = words.counts()
                ids = known.ids(words)
                rows = np.repeat(np.arange(len(n)), n)
                own = ids >= 0
                pairs, tfs = np.unique(rows[own] * len(known) + ids[own], return_counts=True)
                ends = np.searchsorted(pairs, np.arange(len(n) + 1) * len(known))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (pairs % max(len(known), 1), tfs)]
                out = pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), *lists], names=["id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    return source.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


def corpus_counts(index: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, their terms with repeats, and how many documents have each term of the vocabulary.

    A task counts its documents and sends a row for each term that it saw; Spark adds these, and the driver gets a row
    for each term of the vocabulary at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 2, _INT)
        for batch in batches:
            counts[:size] += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=size)
            counts[size] += batch.num_rows
            counts[size + 1] += int(batch.column("n").to_numpy().sum())
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen])], names=["term", "count"])

    rows = index.select("n", "terms").mapInArrow(run, "term long, count long").groupBy("term").agg(F.sum("count").alias("count")).collect()
    counts = np.zeros(size + 2, _INT)
    for row in rows:
        counts[row.term] = row["count"]
    return int(counts[size]), int(counts[size + 1]), counts[:size]


def search_block(index: DataFrame, queries: list[np.ndarray], weights: np.ndarray, n_docs: int, all_terms: int, k: int) -> DataFrame:
    """(query, id, score): the best ``k`` documents of each partition of ``index`` for each query.

    What is best so far in a partition also bounds its later blocks.
    """
    shared = index.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        tops = [Top(k) for _ in queries]
        for batch in batches:
            for first in range(0, batch.num_rows, _DOCS):
                part = batch.slice(first, _DOCS)
                ids, n = part.column("id"), part.column("n").to_numpy()
                ids = ids.fill_null(np.iinfo(_INT).max).to_numpy()
                lists, terms = pa.array(part.column("terms")), part.column("terms").flatten().to_numpy(zero_copy_only=False)
                tfs = part.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(_INT)
                docs = np.repeat(np.arange(len(n)), np.asarray(lists.value_lengths()))
                # documents of like length are neighbours: their impacts are alike, so bounds are close
                order = np.argsort(n, kind="stable")
                place = np.empty(len(n), _INT)
                place[order] = np.arange(len(n))
                m = length_norm(n, n_docs, all_terms)
                impacts = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 20 * m[docs]))
                found = Postings(place[docs], terms.astype(_INT), impacts, len(n))
                for top, query in zip(tops, queries, strict=True):
                    top.names = ids[order]
                    found.search(query, top)
        for q, top in enumerate(tops):
            if len(top.scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top.scores), q, np.int32)), pa.array(top.ids), pa.array(top.scores)], names=["query", "id", "score"])

    return index.mapInArrow(run, "query int, id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query, with ranks: first of parts of the candidates, then of what is left of these."""
    best = [F.col("score").desc(), F.col("id").asc()]
    salt = F.pmod(F.xxhash64("id"), F.lit(_SALTS))
    parts = found.withColumn("salt", salt)
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*best))).filter(F.col("rank") <= k)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*best)))
    return ranked.filter(F.col("rank") <= k).drop("salt")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = 1 << 20,
) -> DataFrame:
    """(item id, rank, document id, score): the ``k`` best of all documents for each item.

    Terms are runs of digits, A-Z as a-z, a-z and non-ASCII characters of whole texts. A term's weight w is
    floor(1000 ln((2 N + 2) / (2 df + 1))), a document's norm m is 50 + (50 n N) div L, and its score the sum of
    w ((1000000000 tf) div (1000 tf + 20 m)) over the item's different terms. Equal scores go by ascending id.

    Items reach the driver as sets of terms, once for each different text, in blocks of about ``block_bytes``. For each
    block the documents are read once, into a table of the block's terms that they hold; from it come N, L, df, and then
    each partition's best documents, of which those of all partitions are ranked. So no task holds more than the postings
    of 4096 documents and one block of items.

    A null text and one without terms are no document and no item; rows of equal item id and text are one item, equal ids
    of different texts have a list each; repeated documents rank one by one; document ids are whole numbers, a null one
    comes last; items that fit nothing have no rows, so either table may be empty; further columns are not read. A very long text is a
    row of a batch.
    """
    ship_package(docs.sparkSession)
    name = items.select(F.col(quoted(item_id)).alias("item"), F.sha2(F.col(quoted(item_text)).cast("string"), 256).alias("t"))
    name = name.filter(F.col("t").isNotNull()).dropDuplicates()
    spark, out = docs.sparkSession, None
    for block in _item_blocks(item_terms(items, item_text), block_bytes):
        vocabulary = Vocabulary({x.encode() for _, terms in block for x in terms})
        queries = [np.sort(vocabulary.numbers(x.encode() for x in terms)) for _, terms in block]
        index = written(index_terms(docs, vocabulary, id_col, text_col), "terms")
        n_docs, all_terms, df = corpus_counts(index, len(vocabulary))
        if n_docs:
            found = _ranked(search_block(index, queries, term_weight(df, n_docs), n_docs, all_terms, k), k)
            texts = spark.createDataFrame([(q, t) for q, (t, _) in enumerate(block)], "query int, t string")
            found = written(found.join(F.broadcast(texts), "query").drop("query"), "ranked")
            out = found if out is None else out.unionByName(found)
        drop_written(index)
    if out is None:
        out = spark.createDataFrame([], "rank int, id long, score long, t string")
    last = F.when(F.col("id") < np.iinfo(_INT).max, F.col("id"))
    out = out.join(name, "t")
    return out.select(F.col("item").alias(item_id), "rank", last.alias(id_col), "score")
