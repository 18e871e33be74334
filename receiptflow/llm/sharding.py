"""Sharding: groups that stay together go, largest first, to the least loaded shard of a heap."""

from __future__ import annotations

from heapq import heapify, heapreplace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from receiptflow.llm.shared import inner_names, quoted, without, written

#: Low bits of ``monotonically_increasing_id``: a row's place in its partition.
_PLACE = (1 << 33) - 1


def longest_first(sizes: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Longest-processing-time schedule: name to shard. Equal sizes go by name, equal loads by shard."""
    loads = [(0, k) for k in range(shards)]
    heapify(loads)
    placed = {}
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = loads[0]
        placed[name] = shard
        heapreplace(loads, (load + size, shard))
    return placed


def place_groups(rows: DataFrame, shards: int, size: str, group: str, pieces: int = 256) -> DataFrame:
    """``rows`` with a column ``shard`` from 0; rows of one ``group`` (64 hex digits) share a shard, loads are near equal.

    A group that alone has ``1 / (shards * pieces)`` of all bytes or more is scheduled by itself: there are at most
    ``shards * pieces``. Smaller ones are put together by their digits to ``shards * pieces`` bundles, which are
    scheduled with them. So the driver's heap sees at most ``2 * shards * pieces`` sizes however many groups there are,
    and the last bundle that a shard gets is some ``pieces``-th part of its load. Rows are only joined to these tables,
    whose size has that bound: they are not shuffled, and a group that a third of all rows share is no hot key.
    """
    total = rows.agg(F.sum(size)).first()[0] or 0
    heavy, unit, shard_a, shard_b = inner_names("heavy", "unit", "a", "b")
    most = shards * pieces
    bundle: Column = F.conv(F.substring(F.col(group), 1, 8), 16, 10).cast("long") % most
    groups = rows.groupBy(group).agg(F.sum(size).alias("bytes")).withColumn("alone", F.col("bytes") * F.lit(most) >= F.lit(total))
    units = groups.groupBy("alone", F.when(F.col("alone"), F.col(group)).otherwise(bundle.cast("string")).alias(unit))
    units = units.agg(F.sum("bytes").alias("bytes"), F.min(group).alias("name")).collect()
    to = longest_first([(u["name"], u["bytes"]) for u in units], shards)
    spark = rows.sparkSession
    alone = [(u[unit], to[u["name"]]) for u in units if u["alone"]]
    bundles = [(int(u[unit]), to[u["name"]]) for u in units if not u["alone"]]
    large = spark.createDataFrame(alone, f"{heavy} string, {shard_a} int")
    small = spark.createDataFrame(bundles, f"{unit} long, {shard_b} int")
    out = rows.join(F.broadcast(large), F.col(group) == F.col(heavy), "left")
    out = out.join(F.broadcast(small), F.col(heavy).isNull() & (bundle == F.col(unit)), "left")
    return out.withColumn("shard", F.coalesce(shard_a, shard_b)).drop(heavy, unit, shard_a, shard_b)


def number_slots(placed: DataFrame, order: list[str]) -> DataFrame:
    """``placed`` with ``slot``: the rows of each shard counted from 0 in the order of these columns, nulls first.

    Rows are sorted by range over all partitions, written, and counted by partition and shard; a row's slot is its place
    in its partition plus the rows of its shard in the partitions before. No shard is ever gathered in a task, and a
    number of the row splits even rows that are equal in all of ``order``.
    """
    part, place, salt, first, count, before = inner_names("part", "place", "salt", "first", "count", "before")
    keys = [F.col("shard"), *[F.col(quoted(c)).asc_nulls_first() for c in order]]
    rows = placed.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(*keys, F.col(salt))
    rows = rows.drop(salt).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    rows = written(rows.withColumns({part: F.shiftright(at, 33).cast("int"), place: at.bitwiseAND(F.lit(_PLACE))}), "slots")
    cells = rows.groupBy(part, "shard").agg(F.min(place).alias(first), F.count(F.lit(1)).alias(count))
    past = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn(before, F.coalesce(F.sum(count).over(past), F.lit(0))).drop(count)
    # a partition is a range, so there are at most as many cells as partitions and shards together
    rows = rows.join(F.broadcast(cells), [part, "shard"])
    return rows.withColumn("slot", F.col(place) - F.col(first) + F.col(before)).drop(part, place, first, before)


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", pieces: int = 256, texts: bool = True) -> DataFrame:
    """Each row of ``docs`` with its shard by the law ``bytes``: sizes near equal, equal texts together.

    Adds ``size`` (UTF-8 bytes of the text, and 16), ``text_crc32`` (unsigned, of the UTF-8 bytes), ``law`` (``bytes``),
    ``shard``, ``slot`` (from 0 in each shard, by the text's SHA-256 and the id) and ``grown_shard`` (null: how many
    shards there are changes all). Without ``texts`` the text is not carried along. Input columns of these names are
    replaced. A null text has no bytes and stays with the empty ones; a null id comes first; repeated rows take a slot
    each; a very long text is a group of its own; an empty table stays empty. The text must not have one of the names.
    """
    outputs = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    if {text_col.lower(), id_col.lower()} & set(outputs):
        raise ValueError(f"neither text nor id may have one of the names {outputs}")
    (group,) = inner_names("group")
    raw = F.coalesce(F.col(quoted(text_col)), F.lit("")).cast("binary")
    rows = without(docs, outputs)
    rows = rows.withColumns({"size": F.octet_length(raw).cast("long") + 16, "text_crc32": F.crc32(raw), group: F.sha2(raw, 256)})
    if not texts:
        rows = rows.drop(F.col(quoted(text_col)))
    rows = written(rows, "sized")
    out = number_slots(place_groups(rows, shards, "size", group, pieces), [group, id_col])
    out = out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}).drop(group)
    kept = [c for c in out.columns if c not in outputs]
    return out.select(*[quoted(c) for c in kept], *outputs)


def write_shards(sharded: DataFrame, folder: str) -> None:
    """The rows of ``shard_documents`` as Parquet, a folder ``shard=K`` for each shard, rows in the order of their slots.

    Rows are dealt by ranges of (shard, slot), so a large shard is several files, written by several tasks.
    """
    keys = ["shard", "slot"]
    sharded.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy("shard").parquet(folder)
