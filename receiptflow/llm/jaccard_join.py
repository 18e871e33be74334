"""Self-join of texts whose sets of word n-grams are alike, by chosen paths.

Each text becomes ``COORDINATES`` minimum hashes of its n-grams: two texts share a coordinate's value with a chance
equal to the Jaccard similarity of their sets. A run of the join starts from all texts; a node of its tree picks
``BRANCHES`` coordinates by a hash of its path, and texts move on to the child named by their value there, so that
similar texts tend to walk down together. Buckets of at most ``CELL`` texts are compared by brute force. A bucket that
is larger but whose texts are alike on average cannot be split by further tokens; it is cut into blocks, and all pairs
of blocks are compared. Runs are repeated until a pair at the threshold is met, and passes the comparison of sketches
in front of the exact one, with the target recall, however deep its bucket lies; ``recall_of`` computes this chance.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.llm.shared import add_columns, blocks, drop_written, without, written
from receiptflow.llm.words import Words, shingles, split_words
from receiptflow.session import ship_package

BRANCHES = 2
COORDINATES = 64
CELL = 400
#: n-grams of the texts of a cell from which it is cut into smaller ones, so that memory is bounded by bytes, not by texts.
CELL_GRAMS = 1 << 22
#: Mean similarity from which a large bucket counts as alike.
ALIKE = 0.5
_U = np.uint64


def least_shared(similarity: float) -> int:
    """Sketch values that two texts must share to be compared exactly: four deviations below what is expected."""
    return math.floor(COORDINATES * similarity - 4.1 * math.sqrt(COORDINATES * similarity * (1 - similarity)))


def recall_of(similarity: float, runs: int) -> float:
    """The chance that a pair of this similarity is met by ``runs`` runs in buckets of the deepest level, and linked.

    The paths of all runs draw from the same coordinates of a level, so the runs are not independent: at each level the
    pair agrees on c of the coordinates, and every path on which it still is together goes on to as many children as it
    drew coordinates among those c. The distribution of the number of such paths is carried from level to level.
    """
    per_level = runs * BRANCHES
    levels = max(1, COORDINATES // per_level)
    most = 64  # with so many paths a pair is not lost any more
    agree = [math.comb(per_level, c) * similarity**c * (1 - similarity) ** (per_level - c) for c in range(per_level + 1)]
    paths = np.zeros(most + 1)
    paths[: per_level + 1] = agree
    for _ in range(levels - 1):
        new = np.zeros(most + 1)
        for c, chance in enumerate(agree):
            draws = math.comb(per_level, BRANCHES)
            step = np.array([math.comb(c, k) * math.comb(per_level - c, BRANCHES - k) / draws for k in range(BRANCHES + 1)])
            children = np.ones(1)
            for n in range(most + 1):
                seen = children[: most + 1].copy()
                seen[-1] += children[most + 1 :].sum()
                new[: len(seen)] += chance * paths[n] * seen
                children = np.convolve(children, step)
        paths = new
    least = least_shared(similarity)
    passed = sum(math.comb(COORDINATES, k) * similarity**k * (1 - similarity) ** (COORDINATES - k) for k in range(least, COORDINATES + 1))
    return (1 - paths[0]) * passed


def runs_for(similarity: float, recall: float) -> int:
    """Repetitions of the random tree until a pair at the threshold is linked with the chance ``recall``."""
    for runs in range(1, COORDINATES // BRANCHES + 1):
        if recall_of(similarity, runs) >= recall:
            return runs
    raise ValueError(f"a recall of {recall} is out of reach with {COORDINATES} coordinates")


# --- sets and sketches -----------------------------------------------------------------------------------------------


def _keys(words: Words) -> list[bytes | None]:
    """128 bits of the SHA-256 of the rows' words as their names; none for a row without words."""
    return [None if x is None else sha256(x).digest()[:16] for x in words.texts()]


def _sketches(values: np.ndarray, rows: np.ndarray) -> pa.Array:
    """For each row the least value of its n-grams under each of ``COORDINATES`` permutations of 32-bit numbers."""
    full = np.flatnonzero(np.diff(rows))
    out = np.zeros((len(rows) - 1, COORDINATES), np.uint32)
    rng = np.random.default_rng(20240229)
    turns = rng.integers(1 << 32, size=(COORDINATES, 2), dtype=np.uint64).astype(np.uint32)
    short = (values >> _U(32)).astype(np.uint32)
    if len(full):
        cuts = rows[:-1][full]
        for k, (flip, factor) in enumerate(turns):
            out[full, k] = np.minimum.reduceat((short ^ flip) * (factor | np.uint32(1)), cuts)
    offsets = np.arange(len(rows), dtype=np.int32) * COORDINATES
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.reshape(-1).view(np.int32)))


def with_key(docs: DataFrame, text_col: str, name: str = "__key") -> DataFrame:
    """``docs`` with the name of each text's word sequence; null for texts without words."""

    def make():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            words = split_words(batch.column(batch.schema.get_field_index(text_col)))
            return [pa.array(_keys(words), pa.binary())]

        return compute

    return add_columns(docs, [T.StructField(name, T.BinaryType())], make, weigh=text_col)


def _sketched(ids: DataFrame, n: int) -> DataFrame:
    """(id, text) as (id, key, sketch, size), the last being the number of n-grams."""

    def make():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            words = split_words(batch.column(1))
            values, rows = shingles(words.hashes(), words.rows, n)
            return [pa.array(_keys(words), pa.binary()), _sketches(values, rows), pa.array(np.diff(rows), pa.int64())]

        return compute

    fields = [T.StructField("key", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.IntegerType())), T.StructField("size", T.LongType())]
    return add_columns(ids, fields, make, weigh="text").drop("text")


def _sets(texts: DataFrame, n: int) -> DataFrame:
    """(text, wanted) as (key, grams) for texts whose key is the wanted one."""

    def make():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            words = split_words(batch.column(0))
            values, rows = shingles(words.hashes(), words.rows, n)
            grams = [np.unique(values[a:b]).view(np.int64) for a, b in zip(rows[:-1], rows[1:], strict=True)]
            return [pa.array(_keys(words), pa.binary()), pa.array(grams, pa.list_(pa.int64()))]

        return compute

    fields = [T.StructField("key", T.BinaryType()), T.StructField("grams", T.ArrayType(T.LongType()))]
    return add_columns(texts, fields, make, weigh="text").filter("key = wanted").select("key", "grams")


# --- the tree --------------------------------------------------------------------------------------------------------


def _buckets(nodes: DataFrame, runs: int) -> tuple[DataFrame, list[DataFrame]]:
    """(key, bucket, blocks) of all buckets that are ready to be compared, and the tables behind it."""
    per_level = runs * BRANCHES
    levels = max(1, COORDINATES // per_level)
    child = lambda path, c, at: F.struct(F.xxhash64(path, F.lit(c), at).alias("path"), F.lit(c).alias("turn"))
    first = F.array(*[child(F.lit(c // BRANCHES), c, F.get("sketch", F.lit(c))) for c in range(per_level)])
    here = nodes.select("key", F.explode(first).alias("x")).select("key", "x.path")
    ready, tables = [], []
    for level in range(levels):
        sizes = written(here.groupBy("path").count().filter("count > 1"), "paths")
        tables.append(sizes)
        leaves = here.join(sizes.filter(F.col("count") <= CELL), "path").select("key", F.col("path").alias("bucket"), F.lit(1).alias("blocks"))
        ready.append(written(leaves, "leaves"))
        large = sizes.filter(F.col("count") > CELL)
        if large.isEmpty():
            break
        blocks = F.ceil(F.col("count") / CELL).cast("int")
        inside = written(here.join(large, "path"), "large")
        tables.append(inside)
        if level + 1 == levels:
            ready.append(inside.select("key", F.col("path").alias("bucket"), blocks.alias("blocks")))
            break
        # two different coordinates of this level, chosen by the path
        a = F.pmod(F.xxhash64("path", F.lit(level)), F.lit(per_level)).cast("int")
        b = F.pmod(a + 1 + F.pmod(F.xxhash64("path", F.lit(-level - 1)), F.lit(per_level - 1)).cast("int"), F.lit(per_level))
        base = (level + 1) * per_level
        steps = F.array(*[F.struct(F.lit(j).alias("turn"), F.get("sketch", base + at).alias("value")) for j, at in enumerate((a, b))])
        moved = inside.join(nodes.select("key", "sketch"), "key").withColumn("step", F.explode(steps))
        moved = moved.select("key", "path", "count", "step.turn", F.xxhash64("path", "step.turn", "step.value").alias("child"))
        moved = written(moved, "moved")
        tables.append(moved)
        met = moved.groupBy("path", "count", "turn", "child").count().toDF("path", "n", "turn", "child", "m")
        alike = met.groupBy("path", "n").agg((F.sum(F.col("m") * F.col("m")) / F.lit(BRANCHES)).alias("pairs"))
        alike = alike.filter(F.col("pairs") >= F.lit(ALIKE) * F.col("n") * F.col("n")).select("path")
        alike = written(alike, "alike")
        tables.append(alike)
        ready.append(inside.join(alike, "path").select("key", F.col("path").alias("bucket"), blocks.alias("blocks")))
        here = moved.join(alike, "path", "left_anti").select("key", F.col("child").alias("path"))
    return reduce(DataFrame.unionByName, ready), tables


def _cells(nodes: DataFrame, buckets: DataFrame) -> DataFrame:
    """A row for each text in each cell: a bucket, or a pair of blocks of one; with all buckets of the text."""
    own = buckets.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("bucket", "blocks"))).alias("b"))
    rows = nodes.select("key", "sketch", "size").join(own, "key")
    rows = rows.select("key", "sketch", "size", F.col("b.bucket").alias("buckets"), F.explode("b").alias("x"))
    rows = rows.select("key", "sketch", "size", "buckets", "x.*")
    rows = rows.withColumn("side", F.pmod(F.xxhash64("key", "bucket"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
    return rows.select("bucket", low, high, "side", "key", "buckets", "size", "sketch")


def _smaller_cells(rows: DataFrame) -> DataFrame:
    """Cells that are to be cut into ``parts`` as pairs of their parts: within a block, or one part of each of two blocks.

    A part is a hash of the key, and its number goes behind that of the block, so each pair of texts still meets once.
    """
    most = F.lit(1 << 20)
    part = F.pmod(F.xxhash64("bucket", "key"), F.col("parts")).cast("long")
    rows = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    one = F.col("low") == F.col("high")
    first = F.when(one, F.least("part", "other")).when(F.col("side") == F.col("low"), F.col("part")).otherwise(F.col("other"))
    second = F.when(one, F.greatest("part", "other")).when(F.col("side") == F.col("low"), F.col("other")).otherwise(F.col("part"))
    low, high, side = (F.col("low") * most + first, F.col("high") * most + second, F.col("side") * most + F.col("part"))
    return rows.select("key", "bucket", low.alias("low"), high.alias("high"), side.alias("side"), "buckets")


# --- comparing the texts of a cell -----------------------------------------------------------------------------------

_CELL_KEY = ["bucket", "low", "high"]


def by_cell(rows: DataFrame, compare: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, weigh: str) -> DataFrame:
    """``compare`` on tables of whole cells, of about 1 M elements of the lists ``weigh`` or of one cell; it has two blocks at most."""
    ship_package(rows.sparkSession)
    sorted_ = rows.repartition(*_CELL_KEY).sortWithinPartitions(*_CELL_KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for part in (x for batch in batches for x in blocks(batch, weigh, 1 << 20)):
            table = pa.Table.from_batches([part])
            table = table if rest is None else pa.concat_tables([rest, table])
            cuts = _cuts(table)
            if len(cuts) > 2:
                yield from compare(table.slice(0, cuts[-2]).combine_chunks())
            rest = table.slice(cuts[-2]) if len(cuts) > 1 else table
        if rest is not None and rest.num_rows:
            yield from compare(rest.combine_chunks())

    return sorted_.mapInArrow(run, schema)


def _cuts(table: pa.Table) -> np.ndarray:
    """Where cells begin, and the end."""
    cols = [table.column(c).to_numpy() for c in _CELL_KEY]
    new = np.ones(table.num_rows, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return np.append(np.flatnonzero(new), table.num_rows)


def _pairs(low: np.ndarray, high: np.ndarray, side: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows to compare, in portions: all pairs of a cell, or those across its two blocks."""
    sizes = np.diff(cuts)
    starts = cuts[:-1]
    square = low[starts] == high[starts]
    for m in np.unique(sizes[square]):
        a, b = np.triu_indices(int(m), 1)
        of = starts[square & (sizes == m)]
        for some in np.array_split(of, max(1, len(of) * len(a) // 100_000)):
            if len(a):
                yield (some[:, None] + a).ravel(), (some[:, None] + b).ravel()
    for first, size in zip(starts[~square], sizes[~square], strict=True):
        own = side[first : first + size] == low[first]
        a, b = np.flatnonzero(own) + first, np.flatnonzero(~own) + first
        yield np.repeat(a, len(b)), np.tile(b, len(a))


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(), np.concatenate([[0], np.cumsum(flat.value_lengths().to_numpy())])


def _bucket_table(table: pa.Table) -> np.ndarray:
    """Each row's buckets, padded with numbers that are unlike any other row's."""
    values, rows = _lists(table.column("buckets"))
    counts = np.diff(rows)
    out = np.full((len(counts), int(counts.max())), np.iinfo(np.int64).max)
    out[np.repeat(np.arange(len(counts)), counts), np.arange(len(values)) - np.repeat(rows[:-1], counts)] = values
    return out


def _owned(buckets: np.ndarray, here: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether this bucket is the first of those that two texts share, so that each pair is counted once."""
    out = np.ones(len(a), bool)
    for i in range(0, len(a), 20_000):
        x, y, own = buckets[a[i : i + 20_000]], buckets[b[i : i + 20_000]], here[a[i : i + 20_000]]
        for k in range(buckets.shape[1]):
            earlier = x[:, k] < own
            if not earlier.any():
                break
            out[i : i + 20_000] &= ~(earlier & (y == x[:, k : k + 1]).any(1))
    return out


def _promising(least: int, most_grams: int) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
    """Rows of cells that share ``least`` sketch values with another row whose pair belongs to this cell.

    They come with the number of parts that the cell is to be cut into for ``most_grams`` n-grams a part.
    """

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        values, _ = _lists(table.column("sketch"))
        sketch = values.reshape(table.num_rows, COORDINATES)
        low, high, side, here = (table.column(c).to_numpy() for c in ("low", "high", "side", "bucket"))
        buckets = _bucket_table(table)
        kept = np.zeros(table.num_rows, bool)
        for a, b in _pairs(low, high, side, _cuts(table)):
            for i in range(0, len(a), 50_000):
                x, y = a[i : i + 50_000], b[i : i + 50_000]
                near = np.count_nonzero(sketch[x] == sketch[y], axis=1) >= least
                x, y = x[near], y[near]
                own = _owned(buckets, here, x, y)
                kept[x[own]] = kept[y[own]] = True
        cuts = _cuts(table)
        grams = np.add.reduceat(np.where(kept, table.column("size").to_numpy(), 0), cuts[:-1])
        parts = pa.array(np.repeat(np.maximum(1, -(-grams // most_grams)), np.diff(cuts)), pa.int64())
        rows = table.drop_columns(["sketch", "size"]).append_column("parts", parts).filter(pa.array(kept))
        yield from rows.combine_chunks().to_batches()

    return compare


def _linked(numerator: int, denominator: int) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
    """Exact links of each cell: how many a text has in it, and the first text of those it hangs together with."""

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cuts = _cuts(table)
        for first, past in zip(cuts[:-1], cuts[1:], strict=True):
            cell = table.slice(first, past - first)
            keys = np.array(cell.column("key").to_pylist(), object)
            at = np.argsort(keys)
            if len(at) < 2:
                continue
            cell, keys = cell.take(at), keys[at]
            grams, rows = _lists(cell.column("grams"))
            sizes = np.diff(rows)
            both = _intersections(grams, rows)
            union = sizes[:, None] + sizes[None, :] - both
            link = both * denominator >= union * numerator
            low, high, side, here = (cell.column(c).to_numpy() for c in ("low", "high", "side", "bucket"))
            link &= side[:, None] != side[None, :] if low[0] != high[0] else ~np.eye(len(at), dtype=bool)
            a, b = np.nonzero(link)
            own = _owned(_bucket_table(cell), here, a, b)
            link[a[~own], b[~own]] = False
            count = link.sum(1)
            some = np.flatnonzero(count)
            if len(some):
                root = np.arange(len(at))
                while True:
                    new = np.minimum(root, np.where(link, root[None, :], len(at)).min(1))
                    if (new == root).all():
                        break
                    root = new
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[some].tolist(), pa.binary()),
                        pa.array(count[some], pa.int64()),
                        pa.array(keys[root[some]].tolist(), pa.binary()),
                    ],
                    names=["key", "links", "root"],
                )

    return compare


def _intersections(grams: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sizes of all intersections of the sets of a cell, by products of their 0/1 rows over shared n-grams."""
    m = len(rows) - 1
    _, of, counts = np.unique(grams, return_inverse=True, return_counts=True)
    shared = counts > 1
    rank = np.cumsum(shared) - 1
    keep = shared[of]
    column, row = rank[of[keep]], np.repeat(np.arange(m), np.diff(rows))[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((m, m), np.float64)
    width = 4096
    for first in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((m, width), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        out += part @ part.T
    return out.astype(np.int64)


# --- groups ----------------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(key, label) of the ends of ``edges`` (a, b): equal labels for what hangs together, the least key of each.

    Every round takes the least label of all neighbours and then the label's own label; each is a grouped minimum or
    a join over tables in the shared folder, until no label changes.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    both = written(both.toDF("a", "b"), "links")
    now = written(both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("least")).select("key", F.least("key", "least").alias("label")), "labels")
    while True:
        told = both.join(now.select(F.col("key").alias("b"), "label"), "b").groupBy(F.col("a").alias("key")).agg(F.min("label").alias("told"))
        new = now.join(told, "key").select("key", F.col("label").alias("old"), F.least("label", "told").alias("label"))
        jump = now.select(F.col("key").alias("label"), F.col("label").alias("next"))
        new = new.join(jump, "label", "left").select("key", "old", F.least("label", F.coalesce("next", "label")).alias("label"))
        new = written(new, "labels")
        changed = not new.filter("old <> label").isEmpty()
        drop_written(now)
        now = new.select("key", "label")
        if not changed:
            drop_written(both)
            return now


def jaccard_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    similarity: tuple[int, int] = (4, 5),
    recall: float = 0.9995,
) -> DataFrame:
    """A row for each row of ``docs``: ``id_col``, ``key``, ``class_id``, ``class_key``, ``n_links``, ``n_copies``, ``kept``.

    Texts are cut into lower-case words of letters, digits and non-ASCII characters; the set of a text has its runs of
    ``n`` words, or all its words as one run if it has fewer. Texts of the same words are one node (``key``); two
    nodes are linked if the Jaccard similarity of their sets is at least ``similarity`` (a fraction, checked on the
    64-bit hashes of their n-grams, of which two may be equal by chance only).
    ``n_links`` counts a node's links, ``n_copies`` the rows with its words; a class is what hangs together by links,
    named by its least id (``class_id``; null if all ids are null) and by the least of its nodes' keys (``class_key``).
    ``kept`` is true for the rows of the class's least (id, key): one row, unless the same id and words are repeated.

    Null and empty texts and texts without words are linked to nothing: key, class_key null, class_id their own id,
    n_links 0, n_copies 1, kept. A very long text is one row of its cells, with all its n-grams; a cell with many n-grams
    is compared part by part, so a task holds two parts of about ``CELL_GRAMS`` or two texts. Equal similarities need
    no order: all links count. An empty table gives an empty one. Other columns are left out.
    No candidates are capped: a bucket is split, or compared as pairs of blocks, however large.
    """
    rows = written(_sketched(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), n), "sketches")
    nodes = rows.filter("key IS NOT NULL").groupBy("key")
    nodes = written(nodes.agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n_copies"), F.first("sketch").alias("sketch"), F.first("size").alias("size")), "nodes")
    share = similarity[0] / similarity[1]
    buckets, tables = _buckets(nodes, runs_for(share, recall))
    schema = "bucket long, low int, high int, side int, key binary, buckets array<long>, parts long"
    near = written(by_cell(_cells(nodes, buckets), _promising(least_shared(share), CELL_GRAMS), schema, "sketch"), "near")
    for table in tables:
        drop_written(table)
    wanted = near.select("key").distinct().join(nodes.select("key", "id"), "key").select("id", F.col("key").alias("wanted"))
    texts = docs.select(F.col(id_col).alias("id0"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(wanted, F.col("id0").eqNullSafe(F.col("id"))).select("text", "wanted")
    sets = written(_sets(texts, n), "sets")
    # an id that stands on many rows of the same words brings their set once for each
    once = sets.groupBy("key").agg(F.first("grams").alias("grams"))
    links = written(by_cell(_smaller_cells(near).join(once, "key"), _linked(*similarity), "key binary, links long, root binary", "grams"), "links")
    labels = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("key").agg(F.sum("links").alias("n_links"))
    joined = nodes.drop("sketch", "size").join(labels, "key", "left").join(counts, "key", "left")
    joined = joined.withColumn("class_key", F.coalesce("label", "key")).drop("label")
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))
    heads = joined.groupBy("class_key").agg(F.min(order).alias("head"))
    joined = joined.join(heads, "class_key")
    joined = written(
        joined.select(
            F.col("key").alias("k"),
            "class_key",
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            "n_copies",
            F.col("head.id").alias("class_id"),
            (F.col("head.key") == F.col("key")).alias("first"),
        ),
        "classes",
    )
    for table in (nodes, near, sets, links, labels):
        drop_written(table)
    out = rows.select("id", "key").join(joined, F.col("key") == F.col("k"), "left")
    alone = F.col("key").isNull()
    return out.select(
        F.col("id").alias(id_col),
        "key",
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        "class_key",
        F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, 1).otherwise(F.col("n_copies")).cast("long").alias("n_copies"),
        (alone | (F.col("first") & F.col("id").eqNullSafe(F.col("class_id")))).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, without near copies: one row of each class of ``jaccard_groups`` stays.

    It is the one of the least id; of rows that repeat this id and its words, the one with the least hash of its columns
    (maps aside). Texts without words all stay.
    """
    groups = jaccard_groups(docs, id_col, text_col, **options).filter("kept AND key IS NOT NULL").select("key", id_col).distinct()
    groups = groups.toDF("kept", "kept_id")
    columns = [f"c{i}" for i in range(len(docs.columns))]  # names that clash with none
    plain = docs.toDF(*columns)
    own_id = F.col(columns[docs.columns.index(id_col)])
    keyed = with_key(plain, columns[docs.columns.index(text_col)], "key")
    hashed = [f.name for f in plain.schema.fields if not re.search(r"map<|variant", f.dataType.simpleString())]
    stay = keyed.filter("key IS NOT NULL").join(groups, (F.col("key") == F.col("kept")) & own_id.eqNullSafe(F.col("kept_id")))
    stay = stay.groupBy("key", own_id.alias("id")).agg(F.min_by(F.struct(*columns), F.xxhash64(*hashed)).alias("row")).select("row.*")
    return stay.unionByName(keyed.filter("key IS NULL").select(*columns)).toDF(*docs.columns)


def class_name(key: Column) -> Column:
    return F.lower(F.hex(key))
