"""Sharding against a plain schedule of all groups, and its laws on skewed tables."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from receiptflow.llm.sharding import longest_first, shard_documents, write_shards
from tests.llm.sql import equals_sql


def brute(sizes, shards):
    """name: size. Always the largest that is left to the least loaded shard, by looking at all."""
    load, to = [0] * shards, {}
    for name in sorted(sizes, key=lambda x: (-sizes[x], x)):
        to[name] = min(range(shards), key=lambda k: (load[k], k))
        load[to[name]] += sizes[name]
    return to


def laws(rows, shards):
    by = defaultdict(list)
    groups = defaultdict(set)
    for r in rows:
        by[r.shard].append(r.slot)
        groups[r.text or ""].add(r.shard)
        raw = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        assert 0 <= r.shard < shards
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    assert all(len(x) == 1 for x in groups.values())


def test_heap_against_a_look_at_all_loads():
    rng = random.Random(3)
    for shards in (1, 2, 7):
        sizes = {f"{k:03}": rng.choice([1, 5, 5, 9, 40]) for k in range(200)}
        assert longest_first(list(sizes.items()), shards) == brute(sizes, shards)


def test_documents_against_the_plain_schedule(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("ab é", k=rng.randint(0, 400))) for _ in range(120)] + [None, "", "hot " * 30]
    rows = [(k if k % 7 else None, rng.choice(texts), "x") for k in range(400)] + [(k, "hot " * 30, "y") for k in range(250)]
    rows += rows[:9]
    table = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string").selectExpr("*", "1 AS slot", "2 AS __group", "3 AS unit")
    got = shard_documents(table, 6, pieces=10_000).collect()
    assert len(got) == len(rows) and {"a.b", "__group", "unit"} <= set(got[0].asDict())
    laws(got, 6)
    sizes = defaultdict(int)
    for _, text, _ in rows:
        sizes[sha256((text or "").encode()).hexdigest()] += len((text or "").encode()) + 16
    to = brute(sizes, 6)
    assert all(r.shard == to[sha256((r.text or "").encode()).hexdigest()] for r in got)


def test_small_groups_in_bundles_leave_loads_even(spark):
    rows = [(k, f"text {k} " * (1 + k % 50)) for k in range(20_000)] + [(k, "one text") for k in range(10_000)]
    got = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8, pieces=64).collect()
    laws(got, 8)
    load = defaultdict(int)
    for r in got:
        load[r.shard] += r.size
    mean = sum(load.values()) / 8
    assert max(load.values()) - min(load.values()) < mean / 64


def test_odd_tables_and_files(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert shard_documents(empty, 4).count() == 0
    one = shard_documents(spark.createDataFrame([(None, None), (1, "x" * 2_000_000)], "doc_id long, text string"), 4).collect()
    laws(one, 4)
    with pytest.raises(ValueError):
        shard_documents(empty.withColumnRenamed("text", "size"), 4, text_col="size")
    rows = [(k, f"t{k % 40}") for k in range(500)]
    made = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 5)
    write_shards(made, f"file://{tmp_path}/out")
    back = spark.read.parquet(f"file://{tmp_path}/out")
    laws(back.collect(), 5)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == [f"shard={k}" for k in range(5)]


def test_op13_query_equals_its_sql(spark):
    equals_sql(spark, "op13_sharding", "/root/testdata/sf0.001")
