"""What a job reads, moves and leaves on disk."""

import os
import re
import time

from pyspark.sql import functions as F

from receiptflow import queries
from receiptflow.adapter import extractions_from_orders
from receiptflow.functions.expr import no_reviews
from receiptflow.operators.load import build_payload
from receiptflow.operators.reconcile import gather, reconcile, review_rows
from receiptflow.operators.shape import shape
from receiptflow.plans.pipeline import outcome_counts, run_pipeline, transform
from receiptflow.schemas import EXTRACTION
from receiptflow.streaming.ingest import ingest_batch
from receiptflow.workspace import materialised, shared_folder
from tests.test_receipts import ITEM, failed, result
from tests.test_tables import batch, texts

SF = "/root/testdata/sf0.001"


def folders(spark):
    """Names of the tables in the shared folder, without what makes them unique."""
    path = shared_folder(spark).removeprefix("file://")
    return sorted(x.rsplit("-", 1)[0] for x in os.listdir(path))


def exchanges(df):
    """The exchanges by a key of a plan before it runs."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", df._jdf.queryExecution().executedPlan().toString())


def test_documents_are_read_and_parsed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def look(text):
        seen.add(1)
        return text

    docs = spark.createDataFrame(texts(batch(spark)).collect(), "value string")
    docs = docs.select(F.udf(look, "string").asNondeterministic()("value").alias("value"))
    before = folders(spark)
    ingest_batch(docs, f"{tmp_path}/t", "0")
    assert seen.value == 3
    ingest_batch(docs, f"{tmp_path}/t", "0")
    assert seen.value == 6 and folders(spark) == before


def test_results_that_are_alike_need_no_matching(spark):
    """Of equal lists of items any is the resolved one; zeros, nulls and another order go the long way, to the same end."""
    twice = [ITEM, ITEM, ("Mild", 0.0, 1.0, 0.0), ("Milk", 1.0, 2.0, 2.0)]
    rows = [r for k in range(3) for r in (result("same", k, "abc"[k], [ITEM, ITEM]), result("zero", k, "abc"[k], twice), result("turned", k, "abc"[k], [ITEM, twice[3]][:: 1 if k else -1]))]
    got = {r.receipt_id: r for r in reconcile(gather(spark.createDataFrame(rows + [failed("one", 1)], EXTRACTION))).collect()}
    assert {k: [x.description for x in r.line_items] for k, r in got.items()} == {"same": [ITEM[0]] * 2, "zero": [ITEM[0], ITEM[0], "Mild", "Milk"], "turned": ["Milk", ITEM[0]]}
    assert not any(r.reviews for r in got.values())


def test_results_stay_where_their_receipts_are(spark):
    """Orders and their lines are dealt out by receipt: to gather what is made of them nothing moves again."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = extractions_from_orders(spark, SF)
        made = exchanges(rows)
        assert len(made) == 8 and len(exchanges(gather(rows))) == len(exchanges(transform(rows))) == 8
    finally:
        spark.conf.set(key, before)


def test_shuffles_end_with_the_write(spark, tmp_path):
    path = spark.conf.get("spark.local.dir", None) or "/tmp"
    files = lambda: {f"{d}/{f}" for d, _, fs in os.walk(path) for f in fs if re.match(r"shuffle_\d+_\d+_0\.data", f)}
    before = files()
    df = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    assert materialised(df, "freed").count() == 100
    for _ in range(50):
        left = {f for f in files() - before if os.path.exists(f)}
        if len(left) <= 4:  # those of the count
            break
        time.sleep(0.1)
    assert len(left) <= 4
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_a_batch_is_written_once(spark):
    before = folders(spark)
    assert outcome_counts(run_pipeline(batch(spark))).first().n_receipts == 3
    new = folders(spark)
    for x in before:
        new.remove(x)
    assert new == ["arrivals", "outcomes", "receipts"]


def test_the_source_of_a_stream_is_small_and_whole(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def look(text):
        seen.add(1)
        return text

    docs = spark.createDataFrame([("1", "one"), ("1-2", "two"), ("7", "three")], "receipt_id string, value string")
    docs = docs.select("receipt_id", F.udf(look, "string").asNondeterministic()("value").alias("value"))
    queries._write_source(docs, f"{tmp_path}/in")
    assert seen.value == 3 and sorted(r.value for r in spark.read.text(f"{tmp_path}/in/*").select("value").collect()) == ["one", "three", "two"]
    assert [r.value for r in spark.read.text(f"{tmp_path}/in/photo=second").collect()] == ["two"]
    names = [f for _, _, fs in os.walk(tmp_path / "in") for f in fs if f.startswith("part-")]
    assert names and all(f.endswith(".gz") for f in names)


def test_payloads_move_without_the_ids_of_items(spark):
    shaped = shape(reconcile(gather(batch(spark))))
    reviews = review_rows(shaped.select("receipt_id", no_reviews().alias("v")), "v", "validate")
    plan = build_payload(shaped, reviews)._jdf.queryExecution().analyzed()
    joins = [plan.apply(i) for i in range(20) if plan.apply(i) is not None and plan.apply(i).nodeName() == "Join"]
    left = joins[0].children().head().schema()
    assert "line_order" in left.json() and [f.name() for f in left.fields()] == ["receipt_id", "store", "record", "line_items"]
    items = left.apply("line_items").dataType().elementType()
    assert "id" not in list(items.fieldNames()) and "receipt_id" not in list(items.fieldNames())
