"""Benchmark decontamination by a generalised suffix automaton of the test items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.llm.shared import add_columns, drop_written, inner_names, without, written
from receiptflow.llm.suffix_automaton import SuffixAutomaton
from receiptflow.llm.words import Words, split_words, utf8
from receiptflow.session import ship_package

_U = np.uint64
_SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("past", T.LongType())]))
_SPANS_ARROW = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))
_NAMES_ARROW = pa.list_(pa.string())


class _Matcher:
    """The automaton over one block of items, and tables that skip the words at which it rests at its root.

    The automaton can only stand above length 1 where a word and the one before follow each other in some item, so
    runs of such pairs, long enough for the shortest window, are all that has to be streamed through it.
    """

    def __init__(self, texts: pa.Array, names: list[list[str]], window: int):
        self.names = names
        found = split_words(texts)
        spelled = [found.data[a:b].tobytes() for a, b in zip(found.starts.tolist(), found.ends.tolist(), strict=True)]
        vocabulary = sorted(set(spelled))
        # different words of the items never share a hash: the seed is chosen so
        self.words = split_words(pa.array([w.decode(errors="surrogateescape") for w in vocabulary], pa.string()))
        self.seed = 0
        while len(np.unique(hashes := self.words.hashes(self.seed))) < len(vocabulary):
            self.seed += 1
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        number = {w: k for k, w in enumerate(vocabulary)}
        ids = np.array([number[w] for w in spelled], np.int64)
        rows = found.rows
        items = [ids[rows[i] : rows[i + 1]].tolist() for i in range(len(texts))]
        self.automaton = SuffixAutomaton(items, window)
        self.shortest = min((min(len(x), window) for x in items if x), default=window)
        inner = np.ones(len(ids), bool)
        inner[rows[:-1][rows[:-1] < len(ids)]] = False
        at = np.flatnonzero(inner)
        self.pairs = np.unique(ids[at - 1] * len(vocabulary) + ids[at]) if len(at) else np.zeros(0, np.int64)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hashes >> _U(44)] = True

    def ids(self, words: Words) -> np.ndarray:
        """The items' ids of words by their hashes, -1 for other words."""
        hashes = words.hashes(self.seed)
        out = np.full(len(hashes), -1, np.int64)
        if len(self.hashes):
            maybe = np.flatnonzero(self.seen[hashes >> _U(44)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            same = self.hashes[at] == hashes[maybe]
            out[maybe[same]] = self.order[at[same]]
        return out

    def match(self, words: Words) -> list[tuple[list[tuple[int, int]], set[int]]]:
        """For each row the spans of its words that are hit, counted from its first, and the items."""
        rows = words.rows
        out: list[tuple[list[tuple[int, int]], set[int]]] = [([], set()) for _ in range(len(rows) - 1)]
        ids = self.ids(words)
        first, past = self._runs(ids, rows)
        if len(first):  # the bytes decide, not the hashes
            size = past - first
            which = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
            equal = words.same(which, self.words, ids[which])
            if not equal.all():
                ids[which[~equal]] = -1
                first, past = self._runs(ids, rows)
        for a, b, r in zip(first.tolist(), past.tolist(), (np.searchsorted(rows, first, side="right") - 1).tolist(), strict=True):
            spans, hit = self.automaton.scan(ids[a:b].tolist())
            if spans:
                out[r][0].extend((a - int(rows[r]) + x, a - int(rows[r]) + y) for x, y in spans)
                out[r][1].update(hit)
        return out

    def extend(self, words: Words, spans: pa.Array, names: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Spans and item ids of each row with those of this block's items added."""
        found = self.match(words)
        if not any(s for s, _ in found):
            return spans.cast(_SPANS_ARROW), names.cast(_NAMES_ARROW)
        lists, ids = spans.to_pylist(), names.to_pylist()
        for r, (s, hit) in enumerate(found):
            lists[r] += [{"first": a, "past": b} for a, b in s]
            ids[r] += {x for k in hit for x in self.names[k]}
        return pa.array(lists, _SPANS_ARROW), pa.array(ids, _NAMES_ARROW)

    def _runs(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-end word of the runs that the automaton has to see."""
        if not len(ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        chained = np.zeros(len(ids) + 1, bool)  # this word and the one before are neighbours in an item
        if len(self.pairs):
            both = np.flatnonzero((ids[1:] >= 0) & (ids[:-1] >= 0)) + 1
            key = ids[both - 1] * len(self.hashes) + ids[both]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            chained[both[self.pairs[at] == key]] = True
        chained[rows] = False
        first = np.flatnonzero((ids >= 0) & ~chained[:-1])
        breaks = np.append(np.flatnonzero(~chained[:-1]), len(ids))
        past = breaks[np.searchsorted(breaks, first, side="right")]
        long = past - first >= self.shortest
        return first[long], past[long]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_pieces(benchmark: DataFrame, item_id: str, item_text: str, window: int, piece_words: int = 5000, most_ids: int = 5000) -> DataFrame:
    """(text, ids): every different text of the items, in pieces, with the ids of the items that have it.

    Pieces of a text overlap by ``window - 1`` words, so no window is lost. Of a text that very many items repeat, the
    ids come in several rows of about ``most_ids``: no row is large.
    """
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.col(item_text).cast("string").alias("text"))
    items = items.filter(F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")).withColumn("t", F.sha2("text", 256))
    parts = items.groupBy("t").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_ids)
    ids = items.select("t", "id").join(parts, "t", "left")
    share = F.pmod(F.xxhash64("id"), F.ceil(F.coalesce("n", F.lit(1)) / most_ids)).alias("share")
    ids = ids.groupBy("t", share).agg(F.sort_array(F.collect_set("id")).alias("ids"))
    texts = items.select("t", "text").dropDuplicates(["t"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, column in zip(batch.column(0), (batch.column(1).slice(i, 1) for i in range(batch.num_rows)), strict=True):
                words = split_words(column)
                n, step = len(words.starts), piece_words - window + 1
                for a in range(0, max(1, n - window + 1), step):
                    b = min(n, a + piece_words)
                    piece = words.data[words.starts[a] : words.ends[b - 1]].tobytes().decode()
                    yield pa.RecordBatch.from_pydict({"t": pa.array([t.as_py()]), "text": pa.array([piece])})

    ship_package(benchmark.sparkSession)
    return texts.mapInArrow(cut, "t string, text string").join(ids, "t").select("text", "ids")


def item_blocks(pieces: DataFrame, block_bytes: int) -> Iterator[tuple[pa.Array, list[list[str]]]]:
    """The pieces in blocks of about ``block_bytes`` of texts and ids, read once, partition by partition."""
    texts: list[str] = []
    names: list[list[str]] = []
    size = 0
    for row in pieces.toLocalIterator():
        texts.append(row.text)
        names.append(list(row.ids))
        size += len(row.text.encode()) + sum(len(x) + 8 for x in row.ids)
        if size >= block_bytes:
            yield pa.array(texts, pa.string()), names
            texts, names, size = [], [], 0
    if texts:
        yield pa.array(texts, pa.string()), names


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    clean_share: int = 20,
    block_bytes: int = 1 << 20,
) -> DataFrame:
    """Each row of ``docs`` with what it shares with the items of ``benchmark``.

    Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters. ``window`` item words
    in a row, or a whole shorter item, are a window; words of a text inside an occurrence of one are hit. Adds
    ``n_words``, ``n_hit``, ``hit_spans`` (word positions from 0, past-the-end), ``items`` (ids as strings, sorted),
    ``contaminated`` (``n_hit`` > 0 and ``clean_share * n_hit >= n_words``) and ``clean_text``: the text without the
    spans, from the first hit word up to the next word that is kept.

    Different item texts come to the driver in blocks of about ``block_bytes`` of texts and ids, each with its own
    automaton, so what is broadcast has a bound. One block is met in the scan of ``docs``; of several, each is a round
    whose result is written to the shared folder before the next, so a task never holds two. The last block is met and the
    outputs are made in one step, so a task has one Python worker.
    Items of equal text are all named, sorted as strings. A null text has no words and stays null; very long texts are one row of a batch, read in linear time; items that are null or without words match nothing; a null item id is
    reported as ``null``; repeated rows get the same result; either table may be empty; input columns named like
    outputs are replaced.
    """
    outputs = ["n_words", "n_hit", "hit_spans", "items", "contaminated", "clean_text"]
    if text_col in outputs:
        raise ValueError(f"the text column may not be named {text_col}")
    names = T.ArrayType(T.StringType())
    inner = inner_names("spans", "items")
    out = without(docs, outputs)
    out = out.withColumns({inner[0]: F.array().cast(_SPANS), inner[1]: F.array().cast(names)})
    first = out
    last = None
    for texts, ids in item_blocks(item_pieces(benchmark, item_id, item_text, window), block_bytes):
        if last is not None:
            before, out = out, written(_against(out, *last, text_col, window, inner), "decontaminated")
            if before is not first:
                drop_written(before)
        last = texts, ids
    matcher = docs.sparkSession.sparkContext.broadcast(None if last is None else _Matcher(*last, window))
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hit_spans", _SPANS),
        T.StructField("items", names),
        T.StructField("contaminated", T.BooleanType()),
        T.StructField("clean_text", T.StringType()),
    ]

    def make():
        machine = matcher.value

        def finish(batch: pa.RecordBatch) -> list[pa.Array]:
            column = batch.column(batch.schema.get_field_index(text_col))
            words = split_words(column)
            counts = words.counts()
            found, hit_items = (batch.column(c) for c in inner)
            if machine is not None:
                found, hit_items = machine.extend(words, found, hit_items)
            spans = [_merged([(s["first"], s["past"]) for s in x]) for x in found.to_pylist()]
            hits = [sum(b - a for a, b in x) for x in spans]
            raw, offsets = utf8(column)
            texts = column.to_pylist() if any(hits) else None
            clean = []
            for r, x in enumerate(spans):
                if x:
                    parts, at = [], int(offsets[r])
                    for a, b in x:
                        a, b = int(words.rows[r]) + a, int(words.rows[r]) + b
                        parts.append(raw[at : words.starts[a]].tobytes())
                        at = int(words.starts[b]) if b < words.rows[r + 1] else int(offsets[r + 1])
                    clean.append(b"".join([*parts, raw[at : offsets[r + 1]].tobytes()]).decode())
                elif texts is not None:
                    clean.append(texts[r])
            return [
                pa.array(counts, pa.int64()),
                pa.array(hits, pa.int64()),
                pa.array([[{"first": a, "past": b} for a, b in x] for x in spans], _SPANS_ARROW),
                pa.array([sorted(set(x)) for x in hit_items.to_pylist()], _NAMES_ARROW),
                pa.array([bool(h) and clean_share * h >= int(n) for h, n in zip(hits, counts, strict=True)], pa.bool_()),
                pa.array(clean, pa.string()) if texts is not None else column.cast(pa.string()),
            ]

        return finish

    return add_columns(out, fields, make, weigh=text_col).drop(*inner)


def _against(docs: DataFrame, texts: pa.Array, ids: list[list[str]], text_col: str, window: int, inner: list[str]) -> DataFrame:
    """``docs`` with the matches of one block of items added to the columns ``inner``: spans and items."""
    matcher = docs.sparkSession.sparkContext.broadcast(_Matcher(texts, ids, window))
    fields = [docs.schema[c] for c in inner]
    past = inner_names("spans", "items")
    before = docs.withColumnsRenamed(dict(zip(inner, past, strict=True)))

    def make():
        machine = matcher.value

        def extend(batch: pa.RecordBatch) -> list[pa.Array]:
            words = split_words(batch.column(batch.schema.get_field_index(text_col)))
            return list(machine.extend(words, *(batch.column(c) for c in past)))

        return extend

    return add_columns(before, fields, make, weigh=text_col).drop(*past)
