"""A query for each operator over receipts derived from the driver's tables, and DuckDB SQL that says the same."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from receiptflow import schemas
from receiptflow.adapter import FLAT_SQL, GROUPS_SQL, RESOLVED_SQL, extractions_from_orders, resolved_from_orders
from receiptflow.functions.expr import float_text, mismatch_confidence, no_reviews, normal_text
from receiptflow.operators import validate as checks
from receiptflow.operators.checks import check_candidates, check_confidence_alignment, check_records
from receiptflow.operators.emit import all_reviews, emit, failure_reviews
from receiptflow.operators.load import accepted, arrivals, build_payload, decide, detect_duplicates, ingest, payload_errors
from receiptflow.operators.matching import exact_is_enough, match_items
from receiptflow.operators.reconcile import (
    disputed_item_fields,
    field_confidence,
    gather,
    item_groups,
    missing_items,
    reconcile,
    reconcile_receipt,
    reconcile_store,
    review_rows,
    uncorroborated_item,
)
from receiptflow.operators.report import clean_share, merged_summary, review_summary, stored_form
from receiptflow.operators.shape import content_hash, shape, shapeable, split_extras
from receiptflow.operators.stores import resolve_stores, store_id
from receiptflow.plans.pipeline import load, outcome_counts, prepare, run_pipeline
from receiptflow.sources.extractions import collect_documents, read_extractions, run_extractors, split_results
from receiptflow.sources.tables import Conflict, batch_tables, compact, fingerprints, read_state, read_table, store_batch, write_tables
from receiptflow.streaming.ingest import ingest_batch, stream_ingest
from receiptflow.workspace import dropped, fresh_folder, materialised, shuffles_freed

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function as a query under its name; ``sql`` goes on from the tables of ``FLAT_SQL``."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql if sql.lstrip().startswith("--") else FLAT_SQL + sql
        return f

    return register


def _gathered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gather(extractions_from_orders(spark, sf_dir))


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialised(resolved_from_orders(spark, sf_dir), "resolved")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shaped receipts, made of the resolved ones as they are read."""
    df = _resolved(spark, sf_dir)
    return shape(df.filter(shapeable(df)))


def _shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shaped receipts, written once for queries that read all of a record several times."""
    df = _resolved(spark, sf_dir)
    shaped = materialised(shape(df.filter(shapeable(df))), "shaped")
    dropped(df)
    return shaped


#: Reviews of disputed store and receipt fields; the perturbations touch the phone and the total only.
FIELD_REVIEWS_SQL = """,
disputed AS (
  SELECT receipt_id, count(*) AS n, count(DISTINCT total) > 1 AS total_off,
         count(DISTINCT coalesce(phone, '')) > 1 AS phone_off
  FROM results GROUP BY receipt_id),
field_reviews AS (
  SELECT r.receipt_id, 'total' AS field_name, source AS extractor_source, r.total::VARCHAR AS extracted_value, of_total AS confidence_score
  FROM results r JOIN disputed d USING (receipt_id) WHERE total_off
  UNION ALL
  SELECT r.receipt_id, 'phone', source, r.phone, 0.0 FROM results r JOIN disputed d USING (receipt_id) WHERE phone_off)"""

ITEM_REVIEWS_SQL = """,
absent AS (
  SELECT g.receipt_id, r.source, r.result_index, g.group_pos FROM (SELECT DISTINCT receipt_id, group_pos FROM members) g
  JOIN results r ON r.receipt_id = g.receipt_id
  ANTI JOIN members m ON m.receipt_id = g.receipt_id AND m.group_pos = g.group_pos AND m.result_index = r.result_index),
item_reviews AS MATERIALIZED (
  SELECT receipt_id, 'missing_line_item' AS field_name, source AS extractor_source, NULL::VARCHAR AS extracted_value, 0.0::DOUBLE AS confidence_score,
         'conflicting_extractions' AS flagged_reason, 'line item ' || group_pos AS extractor_notes FROM absent
  UNION ALL
  SELECT receipt_id, 'line_item', source, description, of_text, 'low_confidence', 'line item ' || group_pos FROM members WHERE members = 1 AND n_results > 1
  UNION ALL
  SELECT m.receipt_id, f.field, m.source, CASE f.field WHEN 'description' THEN m.description WHEN 'quantity' THEN m.quantity::VARCHAR
           WHEN 'unit_price' THEN m.unit_price::VARCHAR ELSE m.line_total::VARCHAR END,
         CASE f.field WHEN 'description' THEN m.of_text ELSE 0.0 END, 'conflicting_extractions', 'line item ' || m.group_pos
  FROM members m JOIN (
    SELECT receipt_id, group_pos, unnest([CASE WHEN count(DISTINCT description) > 1 THEN 'description' END, CASE WHEN count(DISTINCT quantity) > 1 THEN 'quantity' END,
           CASE WHEN count(DISTINCT unit_price) > 1 THEN 'unit_price' END, CASE WHEN count(DISTINCT line_total) > 1 THEN 'line_total' END]) AS field
    FROM members GROUP BY receipt_id, group_pos) f ON f.receipt_id = m.receipt_id AND f.group_pos = m.group_pos WHERE f.field IS NOT NULL)"""

#: A text shaped like a UUID from parts, as ``stable_uuid`` makes it.
_UUID = "concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32])"
STORE_ID_SQL = f"""(SELECT {_UUID} FROM (SELECT sha256('=store' || chr(31) || '=' || name || chr(31) || '=' || address) AS h))"""
_CONF = """CASE WHEN gap <= 0.05 THEN 0.99 ELSE greatest(0.0, least(0.99, 1.0 - gap / CASE WHEN expected <> 0 THEN abs(expected) ELSE gap END)) END"""


def _passing_sql(receipts: str, items: str) -> str:
    """``passing``: receipts that are shaped, with their store's id and fingerprint."""
    return f""",
passing AS MATERIALIZED (
  SELECT *, sha256(concat_ws('|', store_id, transaction_ref, date::VARCHAR, total::VARCHAR)) AS content_hash
  FROM (SELECT *, {STORE_ID_SQL} AS store_id FROM {receipts})
  WHERE transaction_ref IS NOT NULL AND total IS NOT NULL AND receipt_id NOT IN (
    SELECT receipt_id FROM {items} WHERE description IS NULL OR quantity IS NULL OR unit_price IS NULL OR line_total IS NULL))"""


SHAPED_SQL = RESOLVED_SQL + _passing_sql("res0", "items0")


def _validated_sql(receipts: str, items: str) -> str:
    """``expected`` sums, and ``validation_rows`` with their parts."""
    return f""",
products AS (SELECT receipt_id, pos, quantity * unit_price AS expected, abs(line_total - quantity * unit_price) AS gap FROM {items}),
bad_lines AS (SELECT receipt_id, pos, {_CONF} AS confidence_score FROM products WHERE gap >= 0.01),
holes AS (
  SELECT receipt_id, f.field AS field_name FROM (
    SELECT receipt_id, unnest([CASE WHEN description IS NULL THEN 'description' END, CASE WHEN quantity IS NULL THEN 'quantity' END,
           CASE WHEN unit_price IS NULL THEN 'unit_price' END, CASE WHEN line_total IS NULL THEN 'line_total' END]) AS field FROM {items}) f
  WHERE f.field IS NOT NULL),
expected AS (SELECT receipt_id, coalesce(subtotal, total - coalesce(consumption_tax, 0)) AS expected FROM {receipts}),
totals AS (SELECT receipt_id, sum(coalesce(line_total, 0)) AS s FROM {items} GROUP BY receipt_id),
gaps AS (SELECT e.receipt_id, expected, s, abs(s - expected) AS gap FROM expected e LEFT JOIN totals t USING (receipt_id)),
bad_sums AS (SELECT receipt_id, round(1e6 * ({_CONF})) / 1e6 AS confidence_score FROM gaps WHERE gap >= 0.01),
required AS (
  SELECT receipt_id, 'transaction_ref' AS field_name FROM {receipts} WHERE transaction_ref IS NULL
  UNION ALL SELECT receipt_id, 'total' FROM {receipts} WHERE total IS NULL),
empty_sums AS (SELECT receipt_id FROM gaps WHERE s IS NULL AND abs(expected) >= 0.01),
validation_rows AS MATERIALIZED (
  SELECT receipt_id, 'name' AS field_name, 0.0::DOUBLE AS confidence_score FROM {receipts} WHERE name = ''
  UNION ALL SELECT receipt_id, field_name, 0.0 FROM required
  UNION ALL SELECT receipt_id, field_name, 0.0 FROM holes
  UNION ALL SELECT receipt_id, 'line_total', confidence_score FROM bad_lines
  UNION ALL SELECT receipt_id, 'line_item', confidence_score FROM bad_sums
  UNION ALL SELECT receipt_id, 'missing_line_item', 0.0 FROM empty_sums)"""


VALIDATED_SQL = _validated_sql("res0", "items0")


# --- sources and sinks ---


@query("""
SELECT receipt_id, result_index, source, total, of_total AS total_confidence, 0 AS n_corrupt FROM results
UNION ALL SELECT receipt_id, result_index, source, NULL, NULL, 0 FROM failures""")
def s1_read_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "extractions")
    extractions_from_orders(spark, sf_dir).withColumn("unknown", F.lit("dropped")).write.json(path)
    rows, corrupt = read_extractions(spark, path)
    rows = rows.select("receipt_id", "result_index", "source", "candidate.receipt.total", F.col("confidence.receipt")["total"].alias("total_confidence"))
    return rows.withColumn("n_corrupt", F.lit(corrupt.count()))


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """An extractor that reads what an order's text says."""
    for images in batches:
        out = {"receipt_id": images["image_id"], "candidate": [], "confidence": [], "failure": None}
        for content in images["content"]:
            data = json.loads(bytes(content))
            receipt = dict.fromkeys(schemas.RECEIPT) | {"transaction_ref": data["ref"], "total": data["total"]}
            out["candidate"].append({"store": dict.fromkeys(schemas.STORE) | {"name": data["by"]}, "receipt": receipt, "line_items": []})
            out["confidence"].append({"store": {}, "receipt": {"total": 0.5}, "line_items": []})
        yield pd.DataFrame(out)


def _blind(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """An extractor that never finds anything."""
    row = {"field_name": "receipt", "extractor_source": "blind", "confidence_score": 0.0, "flagged_reason": "extraction_failed", "status": "pending"}
    failure = dict.fromkeys(schemas.FAILURE.names) | row
    for images in batches:
        yield pd.DataFrame({"receipt_id": images["image_id"], "candidate": None, "confidence": None, "failure": [failure] * len(images)})


@query("""
SELECT o_orderkey::VARCHAR AS receipt_id, 0 AS result_index, 'reader' AS source, 'T' || o_orderkey AS transaction_ref, o_totalprice AS total, NULL AS failure FROM orders
UNION ALL SELECT o_orderkey::VARCHAR, 1, 'blind', NULL, NULL, 'extraction_failed' FROM orders""")
def s2_run_extractors(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = F.to_json(
        F.struct(F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("ref"), F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("by"))
    )
    images = orders.select(F.col("o_orderkey").cast("string").alias("image_id"), text.cast("binary").alias("content"))
    rows = run_extractors(images, [("reader", _reader), ("blind", _blind)])
    receipt = F.col("candidate.receipt")
    return rows.select(
        "receipt_id", "result_index", "source", receipt["transaction_ref"].alias("transaction_ref"), receipt["total"].alias("total"), F.col("failure.flagged_reason").alias("failure")
    )


@query("""
SELECT receipt_id, result_index, 'result' AS kind FROM results UNION ALL SELECT receipt_id, result_index, 'failure' FROM failures""")
def s3_split_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, failures = split_results(extractions_from_orders(spark, sf_dir))
    tag = lambda df, kind: df.select("receipt_id", "result_index", F.lit(kind).alias("kind"))
    return tag(results, "result").unionByName(tag(failures, "failure"))


#: What is stored: of equal fingerprints the first id.
LOADED_SQL = SHAPED_SQL + """,
first_of AS (SELECT content_hash, min(receipt_id) AS id FROM passing GROUP BY content_hash),
created AS (SELECT p.* FROM passing p JOIN first_of f ON p.receipt_id = f.id)"""


def _loaded(spark: SparkSession, sf_dir: str):
    df = _resolved(spark, sf_dir)
    checked = checks.validate(df)
    shaped = shape(df.filter(shapeable(df)))
    bundle = emit(shaped, checked)
    arrived = materialised(arrivals(shaped), "arrivals")
    outcomes = materialised(decide(arrived), "outcomes")
    dropped(arrived)
    stores = resolve_stores(accepted(bundle.stores, outcomes))
    return bundle, outcomes, stores


@query(LOADED_SQL + """
SELECT c.receipt_id AS id, c.store_id, c.total, count(i.pos) AS n_items, c.name IS NOT NULL AS has_store
FROM created c LEFT JOIN items0 i ON i.receipt_id = c.receipt_id GROUP BY ALL""")
def s4_write_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundle, outcomes, stores = _loaded(spark, sf_dir)
    path = fresh_folder(spark, "tables")
    write_tables(bundle, outcomes, stores, path, "b1")
    items = read_table(spark, path, "line_items").groupBy("receipt_id").agg(F.count(F.lit(1)).alias("n"))
    known = read_table(spark, path, "stores").select(F.col("id").alias("sid"))
    receipts = read_table(spark, path, "receipts").select("id", "store_id", "total")
    rows = receipts.join(items, F.col("id") == F.col("receipt_id"), "left").join(known, F.col("store_id") == F.col("sid"), "left")
    return rows.select("id", "store_id", "total", F.coalesce("n", F.lit(0)).cast("long").alias("n_items"), F.col("sid").isNotNull().alias("has_store"))


@query(SHAPED_SQL + """
SELECT p.receipt_id, p.transaction_ref, p.total, p.extras IS NOT NULL AS has_extras, count(i.pos) AS n_items,
       max(CASE WHEN i.pos = i.n THEN i.description END) AS last_item, NULL::VARCHAR AS store_key, p.name = '' AS has_reviews
FROM passing p LEFT JOIN items0 i ON i.receipt_id = p.receipt_id GROUP BY ALL""")
def s5_build_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _resolved(spark, sf_dir)
    nameless = review_rows(df.select("receipt_id", checks.required_store().alias("v")), "v", "validate")
    payload = build_payload(shape(df.filter(shapeable(df))), nameless)
    kind = "struct<store:struct<id:string>,receipt:struct<transaction_ref:string,total:double,extras:string,line_items:array<struct<description:string>>>,extraction_reviews:array<string>>"
    p = F.from_json("payload", kind)
    return payload.select(
        "receipt_id",
        p["receipt"]["transaction_ref"].alias("transaction_ref"),
        p["receipt"]["total"].alias("total"),
        p["receipt"]["extras"].isNotNull().alias("has_extras"),
        F.size(p["receipt"]["line_items"]).cast("long").alias("n_items"),
        F.get(p["receipt"]["line_items"], F.size(p["receipt"]["line_items"]) - 1)["description"].alias("last_item"),
        p["store"]["id"].alias("store_key"),
        F.col("payload").contains('"extraction_reviews":').alias("has_reviews"),
    )


# --- checks ---


@query("""
SELECT receipt_id, result_index, concat_ws('; ', CASE WHEN k % 29 = 0 THEN 'store.name is required' END,
       CASE WHEN k % 31 = 0 THEN 'receipt.total is required' END) AS errors FROM results WHERE k % 29 = 0 OR k % 31 = 0""")
def t1_check_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extractions_from_orders(spark, sf_dir)
    k, c = F.col("k"), F.col("candidate")
    holed = c.withField("store.name", F.when(k % 29 != 0, c["store"]["name"])).withField("receipt.total", F.when(k % 31 != 0, c["receipt"]["total"]))
    _, odd = check_candidates(rows.withColumn("candidate", F.when(c.isNotNull(), holed)))
    return odd.select("receipt_id", "result_index", F.concat_ws("; ", "errors").alias("errors"))


@query(SHAPED_SQL + f"""
SELECT 'receipt' AS kind, receipt_id AS id, CASE WHEN k % 3 = 0 THEN 'total is required' ELSE '' END AS errors FROM passing
UNION ALL SELECT 'store', store_id, CASE WHEN k % 5 = 0 THEN 'address is required' ELSE '' END FROM passing
UNION ALL SELECT 'line_item', (SELECT {_UUID} FROM (SELECT sha256('=item' || chr(31) || '=' || i.receipt_id || chr(31) || '=' || i.pos) AS h)),
  concat_ws('; ', CASE WHEN i.k % 7 = 0 THEN 'description is required' END, CASE WHEN i.k % 2 = 0 THEN 'line_order is required' END)
FROM items0 i SEMI JOIN passing USING (receipt_id)
UNION ALL SELECT 'review', (SELECT {_UUID} FROM (SELECT sha256('=' || receipt_id || chr(31) || '=extract' || chr(31) || '=1') AS h)),
  concat_ws('; ', CASE WHEN k % 2 = 0 THEN 'confidence_score is not between 0 and 1' END, CASE WHEN k % 3 = 0 THEN 'flagged_reason is unknown' END,
            CASE WHEN k % 5 = 0 THEN 'status is unknown' END) FROM failures""")
def t2_check_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped, k = _records(spark, sf_dir), F.col("k")
    none = lambda every, name: F.when(k % every != 0, F.col(name))
    receipts = shaped.select("k", "record.*").withColumn("total", none(3, "total"))
    stores = shaped.select("k", "store.*").withColumn("address", none(5, "address"))
    items = shaped.select("k", F.explode("items").alias("i")).select("k", "i.*")
    items = items.withColumns({"description": none(7, "description"), "line_order": none(2, "line_order")})
    _, failures = split_results(extractions_from_orders(spark, sf_dir))
    reviews = failure_reviews(failures).withColumn("k", F.regexp_replace("receipt_id", "-2$", "").cast("long"))
    odd = {"confidence_score": (2, 1.5), "flagged_reason": (3, "no reason"), "status": (5, "no status")}
    reviews = reviews.withColumns({c: F.when(k % every == 0, F.lit(v)).otherwise(F.col(c)) for c, (every, v) in odd.items()})
    tables = {"receipt": receipts, "store": stores, "line_item": items, "review": reviews}
    rows = [check_records(df, kind).select(F.lit(kind).alias("kind"), "id", F.concat_ws("; ", "errors").alias("errors")) for kind, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


@query("""
SELECT r.receipt_id, r.result_index, r.source, count(i.pos) AS n_items FROM results r JOIN ritems i ON i.receipt_id = r.receipt_id AND i.result_index = r.result_index
WHERE r.k % 9 = 0 GROUP BY ALL""")
def t3_check_confidence_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extractions_from_orders(spark, sf_dir)
    scores = F.when(F.col("k") % 9 == 0, F.slice("confidence.line_items", F.lit(1), F.greatest(F.size("confidence.line_items") - 1, F.lit(0))))
    shorter = F.col("confidence").withField("line_items", F.coalesce(scores, F.col("confidence.line_items")))
    _, odd = check_confidence_alignment(rows.withColumn("confidence", F.when(F.col("confidence").isNotNull(), shorter)))
    return odd.select("receipt_id", "result_index", "source", F.size("candidate.line_items").cast("long").alias("n_items"))


# --- reconcile ---


@query(FIELD_REVIEWS_SQL + """
SELECT receipt_id, name, address, NULL::VARCHAR AS phone, count(*) FILTER (WHERE phone_off) AS n_reviews
FROM results JOIN disputed USING (receipt_id) GROUP BY receipt_id, name, address""")
def r1_reconcile_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = reconcile_store(_gathered(spark, sf_dir))
    return df.select("receipt_id", "store.name", "store.address", "store.phone", F.size("store_reviews").cast("long").alias("n_reviews"))


@query(FIELD_REVIEWS_SQL + """
SELECT receipt_id, any_value(transaction_ref) AS transaction_ref, any_value(date)::VARCHAR AS date, any_value(subtotal) AS subtotal,
       CASE WHEN total_off THEN NULL ELSE any_value(total) END AS total, count(*) FILTER (WHERE total_off) AS n_reviews
FROM results JOIN disputed USING (receipt_id) GROUP BY receipt_id, total_off""")
def r2_reconcile_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = reconcile_receipt(_gathered(spark, sf_dir))
    r = F.col("receipt")
    return df.select(
        "receipt_id", r["date"].cast("string").alias("date"), *[r[f].alias(f) for f in ("transaction_ref", "subtotal", "total")], F.size("receipt_reviews").cast("long").alias("n_reviews")
    )


@query(FIELD_REVIEWS_SQL + """
SELECT * FROM field_reviews""")
def r3_conflict_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = reconcile_receipt(reconcile_store(_gathered(spark, sf_dir))).withColumn("v", F.concat("store_reviews", "receipt_reviews"))
    rows = df.select("receipt_id", F.explode_outer("v").alias("v")).filter("v IS NOT NULL")
    return rows.select("receipt_id", "v.field_name", "v.extractor_source", "v.extracted_value", "v.confidence_score")


@query("""
SELECT receipt_id, result_index, of_total AS total_confidence, 0.0::DOUBLE AS ref_confidence FROM results""")
def r4_field_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = split_results(extractions_from_orders(spark, sf_dir))
    scores = F.col("confidence.receipt")
    return rows.select(
        "receipt_id", "result_index", field_confidence(scores, "total").alias("total_confidence"), field_confidence(scores, "transaction_ref").alias("ref_confidence")
    )


@query("""-- over parts
SELECT p_partkey, lower(p_name || ' ' || p_brand) AS key FROM part""")
def r5_normalize_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    raw = F.concat(F.lit("\t "), F.upper("p_name"), F.lit(" "), F.col("p_brand"), F.lit(" \n"))
    return part.select("p_partkey", normal_text(raw).alias("key"))


def _members(matched: DataFrame) -> DataFrame:
    """A row for each item, with its group."""
    rows = matched.select("receipt_id", F.posexplode("items").alias("i", "x"), "group_of")
    return rows.select("receipt_id", (F.col("x.result")).alias("result"), "x.pos", "x.source", "x.key", F.get("group_of", F.col("i")).alias("group_pos"))


@query(GROUPS_SQL + """
SELECT receipt_id, key, group_pos, members AS n_members FROM members ANTI JOIN fuzzy USING (receipt_id) GROUP BY ALL""")
def r6_match_items_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(match_items(_gathered(spark, sf_dir)).filter(exact_is_enough("items", F.size("results")))).groupBy("receipt_id", "key", "group_pos").agg(F.count(F.lit(1)).alias("n_members")).withColumn(
        "group_pos", F.col("group_pos").cast("long")
    )


@query(GROUPS_SQL + """,
results_in_order AS (SELECT receipt_id, result_index, row_number() OVER (PARTITION BY receipt_id ORDER BY result_index) - 1 AS place FROM results)
SELECT m.receipt_id, o.place::INTEGER AS result, (m.pos - 1)::INTEGER AS pos, m.key, m.group_pos::INTEGER AS group_pos
FROM members m SEMI JOIN fuzzy USING (receipt_id) JOIN results_in_order o ON o.receipt_id = m.receipt_id AND o.result_index = m.result_index""")
def r7_match_items_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match_items(_gathered(spark, sf_dir)).filter(~exact_is_enough("items", F.size("results"))).select("receipt_id", F.posexplode("items").alias("i", "x"), "group_of")
    return rows.select("receipt_id", "x.result", "x.pos", "x.key", F.get("group_of", F.col("i")).alias("group_pos"))


@query(GROUPS_SQL + """
SELECT receipt_id, source, pos AS item_pos, group_pos FROM members""")
def r8_item_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _members(match_items(_gathered(spark, sf_dir)))
    return rows.select("receipt_id", "source", (F.col("pos") + 1).cast("long").alias("item_pos"), F.col("group_pos").cast("long"))


def _item_reviews(spark: SparkSession, sf_dir: str, of) -> DataFrame:
    df = item_groups(match_items(_gathered(spark, sf_dir)))
    note = lambda p: F.concat(F.lit("line item "), p + 1)
    rows = df.withColumn("v", F.flatten(F.transform("groups", lambda g, p: of(g, note(p)))))
    rows = rows.select("receipt_id", F.explode_outer("v").alias("v")).filter("v IS NOT NULL")
    names = ("field_name", "extractor_source", "extracted_value", "confidence_score", "flagged_reason", "extractor_notes")
    return rows.select("receipt_id", *[F.col(f"v.{n}") for n in names])


@query(GROUPS_SQL + ITEM_REVIEWS_SQL + """
SELECT * FROM item_reviews WHERE field_name = 'missing_line_item'""")
def r9_missing_item_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_reviews(spark, sf_dir, missing_items)


@query(GROUPS_SQL + ITEM_REVIEWS_SQL + """
SELECT * FROM item_reviews WHERE field_name = 'line_item'""")
def r10_uncorroborated_item_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_reviews(spark, sf_dir, uncorroborated_item)


@query(GROUPS_SQL + """
SELECT receipt_id, group_pos, description, quantity, unit_price, line_total FROM members WHERE members = 1""")
def r11_single_item_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = item_groups(match_items(_gathered(spark, sf_dir)))
    rows = df.select("receipt_id", F.posexplode_outer("groups").alias("p", "g")).filter(F.size("g") == 1)
    item = F.get("g", F.lit(0))["item"]
    return rows.select("receipt_id", (F.col("p") + 1).cast("long").alias("group_pos"), *[item[f].alias(f) for f in schemas.ITEM])


@query(GROUPS_SQL + ITEM_REVIEWS_SQL + """
SELECT * FROM item_reviews WHERE field_name NOT IN ('line_item', 'missing_line_item')""")
def r12_reconcile_item_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_reviews(spark, sf_dir, disputed_item_fields)


RECONCILED_SQL = RESOLVED_SQL + ITEM_REVIEWS_SQL + FIELD_REVIEWS_SQL + """,
all_reviews AS MATERIALIZED (
  SELECT receipt_id, field_name, extractor_source, extracted_value, confidence_score, flagged_reason, extractor_notes FROM item_reviews
  UNION ALL
  SELECT receipt_id, field_name, extractor_source, extracted_value, confidence_score, 'conflicting_extractions', NULL FROM field_reviews)"""


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All receipts with a candidate, written once for the queries that explode their reviews."""
    return materialised(reconcile(_gathered(spark, sf_dir)), "reconciled")


@query(RECONCILED_SQL + """,
item_count AS (SELECT receipt_id, count(DISTINCT group_pos) AS n FROM members GROUP BY receipt_id),
review_count AS (SELECT receipt_id, count(*) AS n FROM all_reviews GROUP BY receipt_id)
SELECT a.receipt_id, a.n_results, coalesce(i.n, 0) AS n_items, coalesce(r.n, 0) AS n_reviews FROM alike a
LEFT JOIN item_count i USING (receipt_id) LEFT JOIN review_count r USING (receipt_id)""")
def r13_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _reconciled(spark, sf_dir)
    return df.select(
        "receipt_id",
        F.col("n_results").cast("long").alias("n_results"),
        F.size("line_items").cast("long").alias("n_items"),
        F.size("reviews").cast("long").alias("n_reviews"),
    )


# --- validate ---


def _validation(spark: SparkSession, sf_dir: str, rows) -> DataFrame:
    df = _resolved(spark, sf_dir).withColumn("v", rows).select("receipt_id", F.explode_outer("v").alias("v")).filter("v IS NOT NULL")
    return df.select("receipt_id", "v.field_name", "v.confidence_score")


@query(RESOLVED_SQL + """
SELECT receipt_id, 'name' AS field_name, 0.0::DOUBLE AS confidence_score FROM res0 WHERE name = ''""")
def v1_required_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir, checks.required_store())


@query(RESOLVED_SQL + VALIDATED_SQL + """
SELECT receipt_id, field_name, 0.0::DOUBLE AS confidence_score FROM required""")
def v2_required_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir, checks.required_receipt())


@query(RESOLVED_SQL + VALIDATED_SQL + """
SELECT receipt_id, field_name, 0.0::DOUBLE AS confidence_score FROM holes""")
def v3_required_line_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir, F.flatten(F.transform("line_items", checks.required_line_item)))


@query(RESOLVED_SQL + VALIDATED_SQL + """
SELECT receipt_id, 'line_total' AS field_name, confidence_score FROM bad_lines""")
def v4_line_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir, F.flatten(F.transform("line_items", checks.line_arithmetic)))


@query(RESOLVED_SQL + VALIDATED_SQL + """
SELECT receipt_id, round(100 * expected) / 100 AS expected FROM expected""")
def v5_expected_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir).select("receipt_id", (F.round(100 * checks.expected_sum()) / 100).alias("expected"))


@query(RESOLVED_SQL + VALIDATED_SQL + """
SELECT receipt_id, 'line_item' AS field_name, confidence_score FROM bad_sums""")
def v6_sum_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _validation(spark, sf_dir, checks.sum_mismatch())
    return rows.withColumn("confidence_score", F.round(1e6 * F.col("confidence_score")) / 1e6)


@query(RESOLVED_SQL + VALIDATED_SQL + """
SELECT receipt_id, 'missing_line_item' AS field_name, 0.0::DOUBLE AS confidence_score FROM empty_sums""")
def v7_no_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir, checks.no_items())


@query(f"""-- over all lines
SELECT l_orderkey, l_linenumber, l_extendedprice, ({_CONF}) AS confidence
FROM (SELECT *, l_quantity * round(l_extendedprice / l_quantity) AS expected, abs(l_extendedprice - l_quantity * round(l_extendedprice / l_quantity)) AS gap FROM lineitem)""")
def v8_mismatch_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    expected = F.col("l_quantity") * F.round(F.col("l_extendedprice") / F.col("l_quantity"))
    return line.select("l_orderkey", "l_linenumber", "l_extendedprice", mismatch_confidence(F.col("l_extendedprice"), expected).alias("confidence"))


@query(RESOLVED_SQL + VALIDATED_SQL + """
SELECT receipt_id, field_name, round(1e6 * confidence_score) / 1e6 AS confidence_score FROM validation_rows""")
def v9_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review_rows(checks.validate(_resolved(spark, sf_dir)), "validation_reviews", "validate")
    return rows.select("receipt_id", "field_name", (F.round(1e6 * F.col("confidence_score")) / 1e6).alias("confidence_score"))


# --- shape and emit ---


@query(RESOLVED_SQL + """
SELECT receipt_id, '{"extras":' || extras || '}' AS extras, extras AS flat FROM res0""")
def h1_split_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _resolved(spark, sf_dir)
    return df.select("receipt_id", split_extras(df).alias("extras"), split_extras(df, flatten=True).alias("flat"))


@query(SHAPED_SQL + """
SELECT i.receipt_id, i.pos AS line_order, i.description FROM items0 i JOIN passing USING (receipt_id)""")
def h2_assign_line_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _shaped(spark, sf_dir).select(F.explode("items").alias("i"))
    return rows.select("i.receipt_id", F.col("i.line_order").cast("long").alias("line_order"), "i.description")


@query(SHAPED_SQL + """
SELECT receipt_id, store_id, content_hash FROM passing""")
def h3_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _resolved(spark, sf_dir)
    r, sid = F.col("receipt"), store_id(F.col("store.name"), F.col("store.address"))
    passing = df.filter(shapeable(df))
    return passing.select("receipt_id", sid.alias("store_id"), content_hash(sid, r["transaction_ref"], r["date"], r["total"]).alias("content_hash"))


@query(SHAPED_SQL + FIELD_REVIEWS_SQL + """
SELECT r.receipt_id, p.receipt_id IS NOT NULL AS passed, p.receipt_id IS NOT NULL AND NOT total_off AND NOT phone_off AS passed_strictly
FROM res0 r JOIN disputed USING (receipt_id) LEFT JOIN passing p ON p.receipt_id = r.receipt_id""")
def h4_shapeable(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _resolved(spark, sf_dir)
    return df.select("receipt_id", shapeable(df).alias("passed"), shapeable(df, "any_conflict").alias("passed_strictly"))


@query(SHAPED_SQL + f"""
SELECT (SELECT {_UUID} FROM (SELECT sha256('=item' || chr(31) || '=' || i.receipt_id || chr(31) || '=' || i.pos) AS h)) AS id,
       i.receipt_id, i.description, i.quantity, i.unit_price, i.line_total, i.pos::INTEGER AS line_order
FROM items0 i JOIN passing USING (receipt_id)""")
def h5_shape_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _resolved(spark, sf_dir)
    extra = F.transform("line_items", lambda x: x.withField("id", F.lit("taken")).withField("line_order", F.lit(999)))
    shaped = shape(df.filter(shapeable(df)).withColumn("line_items", extra))
    return shaped.select(F.explode("items").alias("i")).select("i.*")


@query(SHAPED_SQL + """
SELECT receipt_id, store_id AS id, name, address FROM passing""")
def h6_shape_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(spark, sf_dir).select("receipt_id", "store.id", "store.name", "store.address")


@query(RECONCILED_SQL + _validated_sql("agreed", "agreed_items") + """
SELECT 'reconcile' AS origin, field_name, flagged_reason, count(*) AS n_reviews FROM all_reviews GROUP BY ALL
UNION ALL SELECT 'validate', field_name, 'validation_failed', count(*) FROM validation_rows GROUP BY ALL
UNION ALL SELECT 'extract', 'receipt', 'extraction_failed', count(*) FROM failures GROUP BY ALL""")
def e1_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    validated = checks.validate(_reconciled(spark, sf_dir))
    _, failures = split_results(extractions_from_orders(spark, sf_dir))
    rows = all_reviews(validated, failures)
    return rows.groupBy("origin", "field_name", "flagged_reason").agg(F.count(F.lit(1)).alias("n_reviews"))


@query(f"""
SELECT (SELECT {_UUID} FROM (SELECT sha256('=' || receipt_id || chr(31) || '=extract' || chr(31) || '=1') AS h)) AS id,
       receipt_id, 'receipt' AS field_name, source AS extractor_source, 0.0::DOUBLE AS confidence_score, 'extraction_failed' AS flagged_reason, 'pending' AS status FROM failures""")
def e2_merge_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failures = split_results(extractions_from_orders(spark, sf_dir))
    return failure_reviews(failures).select("id", "receipt_id", "field_name", "extractor_source", "confidence_score", "flagged_reason", "status")


# --- load ---


@query(f""",
ids AS (SELECT DISTINCT name, address FROM base WHERE address NOT IN (SELECT min(n_name) FROM nation))
SELECT {STORE_ID_SQL} AS id, name, address FROM ids""")
def l1_resolve_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = split_results(extractions_from_orders(spark, sf_dir))
    candidates = rows.select("receipt_id", "candidate.store.*")
    first = spark.read.parquet(f"{sf_dir}/nation.parquet").agg(F.min("n_name").alias("address"))
    existing = candidates.join(F.broadcast(first), "address").select("name", "address").distinct()
    return resolve_stores(candidates, existing).select("id", "name", "address")


@query(SHAPED_SQL + """
SELECT receipt_id, CASE WHEN k % 6 = 0 THEN 'receipt.content_hash is required' WHEN k % 10 = 0 THEN 'receipt.total is required' END AS error FROM passing""")
def l2_payload_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, r, k = _shaped(spark, sf_dir), F.col("record"), F.col("k")
    holed = r.withField("content_hash", F.when(k % 6 != 0, r["content_hash"])).withField("total", F.when(k % 10 != 0, r["total"]))
    df = df.withColumn("record", holed)
    return df.select("receipt_id", F.get(payload_errors(F.col("store"), F.col("record")), F.lit(0)).alias("error"))


@query(LOADED_SQL + """
SELECT p.receipt_id AS id, CASE WHEN f.id <> p.receipt_id THEN f.id END AS existing_receipt_id FROM passing p JOIN first_of f USING (content_hash)""")
def l3_detect_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipts = _records(spark, sf_dir).select("record.id", "record.content_hash", F.lit(0).alias("arrival_seq"))
    return detect_duplicates(materialised(receipts, "arrivals")).select("id", "existing_receipt_id")


@query(SHAPED_SQL + """,
held AS (SELECT content_hash, min(receipt_id) AS id FROM passing WHERE k % 2 = 0 GROUP BY content_hash),
fresh AS (SELECT content_hash, min(receipt_id) AS id FROM passing WHERE k % 6 <> 0 GROUP BY content_hash)
SELECT p.receipt_id, CASE WHEN k % 6 = 0 THEN 'validation_error' WHEN n.id IS NOT NULL OR f.id <> p.receipt_id THEN 'duplicate' ELSE 'created' END AS status,
       CASE WHEN k % 6 = 0 THEN NULL WHEN n.id IS NOT NULL THEN n.id WHEN f.id <> p.receipt_id THEN f.id END AS existing_receipt_id
FROM passing p LEFT JOIN held n USING (content_hash) LEFT JOIN fresh f USING (content_hash)""")
def l4_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, k, r = _records(spark, sf_dir), F.col("k"), F.col("record")
    existing = df.filter(k % 2 == 0).select("record.id", "record.content_hash")
    batch = df.withColumn("record", r.withField("content_hash", F.when(k % 6 != 0, r["content_hash"])))
    return decide(materialised(arrivals(batch), "arrivals"), existing).select("receipt_id", "status", "existing_receipt_id")


# --- the whole way ---


@query(RESOLVED_SQL + _passing_sql("agreed", "agreed_items") + """
SELECT (SELECT count(DISTINCT receipt_id) FROM base) AS n_receipts, count(DISTINCT p.content_hash) AS n_created,
       count(p.receipt_id) - count(DISTINCT p.content_hash) AS n_duplicate, 0::BIGINT AS n_refused, count(*) FILTER (WHERE p.receipt_id IS NULL) AS n_review_only,
       (SELECT count(DISTINCT receipt_id) FROM base) - count(*) AS n_without_candidate, 0::BIGINT AS n_quarantined
FROM agreed a LEFT JOIN passing p ON p.receipt_id = a.receipt_id""")
def p1_run_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_counts(run_pipeline(extractions_from_orders(spark, sf_dir)))


@query(RECONCILED_SQL + """
SELECT extractor_source, flagged_reason, field_name, count(*) AS n_reviews, count(DISTINCT receipt_id) AS n_receipts,
       round(1e6 * avg(confidence_score)) / 1e6 AS mean_confidence FROM all_reviews GROUP BY ALL""")
def q1_review_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review_rows(_reconciled(spark, sf_dir), "reviews", "reconcile")
    return review_summary(rows).withColumn("mean_confidence", F.round(1e6 * F.col("mean_confidence")) / 1e6)


@query(RESOLVED_SQL + VALIDATED_SQL + """
SELECT count(*) AS n_receipts, count(*) FILTER (WHERE receipt_id NOT IN (SELECT receipt_id FROM validation_rows)) AS n_clean,
       round(1e6 * count(*) FILTER (WHERE receipt_id NOT IN (SELECT receipt_id FROM validation_rows)) / count(*)) / 1e6 AS clean_share FROM res0""")
def q1_clean_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checks.validate(_resolved(spark, sf_dir))
    rows = review_rows(checked, "validation_reviews", "validate")
    return clean_share(checked, rows).withColumn("clean_share", F.round(1e6 * F.col("clean_share")) / 1e6)


@query(LOADED_SQL + VALIDATED_SQL + """
SELECT v.receipt_id, field_name, round(1e6 * confidence_score) / 1e6 AS confidence_score FROM validation_rows v JOIN created c ON c.receipt_id = v.receipt_id""")
def w3_audit_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundle, outcomes, _ = _loaded(spark, sf_dir)
    receipts = accepted(bundle.receipts.withColumnRenamed("id", "receipt_id"), outcomes).withColumnRenamed("receipt_id", "id")
    stores = bundle.stores.drop("receipt_id").distinct()
    rows = stored_form(receipts, accepted(bundle.line_items, outcomes), stores)
    found = review_rows(checks.validate(rows), "validation_reviews", "validate")
    return found.select("receipt_id", "field_name", (F.round(1e6 * F.col("confidence_score")) / 1e6).alias("confidence_score"))


def _write_source(docs: DataFrame, path: str) -> None:
    """Documents (``receipt_id``, ``value``) as the source of a stream, second photos in a folder of their own.

    They are derived once, and their text is compressed: it is a dozen times as large as the tables that come of it.
    """
    folder = F.when(F.col("receipt_id").like("%-2"), "second").otherwise("first")
    with shuffles_freed(docs.sparkSession):
        docs.select("value", folder.alias("photo")).write.partitionBy("photo").option("compression", "gzip").text(path)


@query(RESOLVED_SQL + _passing_sql("agreed", "agreed_items") + """
SELECT content_hash, count(*) AS n_photos, 1::BIGINT AS n_created FROM passing GROUP BY content_hash""")
def x1_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "stream")
    docs = collect_documents(extractions_from_orders(spark, sf_dir))
    _write_source(docs.select("receipt_id", F.to_json(F.struct("receipt_id", "results")).alias("value")), f"{folder}/in")
    stream_ingest(spark, f"{folder}/in/*", f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    receipts = read_table(spark, f"{folder}/tables", "receipts").groupBy("content_hash").agg(F.count(F.lit(1)).alias("n_created"))
    outcomes = read_table(spark, f"{folder}/tables", "outcomes")
    first = outcomes.select(F.coalesce("existing_receipt_id", "receipt_id").alias("rid"))
    photos = first.groupBy("rid").agg(F.count(F.lit(1)).alias("n_photos"))
    named = read_table(spark, f"{folder}/tables", "receipts").select(F.col("id").alias("rid"), "content_hash")
    return photos.join(named, "rid").join(receipts, "content_hash").select("content_hash", "n_photos", "n_created")


#: Documents that are broken on purpose, by their order: how, and what is left of them.
_BROKEN = {59: "cut", 61: "empty", 67: "nameless", 79: "typed", 71: "incomplete", 73: "third"}
_BROKEN_SQL = "CASE " + " ".join(f"WHEN k % {n} = 0 THEN '{how}'" for n, how in _BROKEN.items()) + " ELSE '' END"


def _broken_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, value): a document of each receipt, some cut off, without results, an identifier, a number, a total or a date."""
    rows = extractions_from_orders(spark, sf_dir).withColumn("how", F.expr(_BROKEN_SQL))
    c, how = F.col("candidate"), F.col("how")
    holed = c.withField("receipt.total", F.when(how != "incomplete", c["receipt"]["total"]))
    holed = holed.withField("receipt.date", F.when((how != "third") | (F.col("result_index") < 2), c["receipt"]["date"]))
    docs = collect_documents(rows.withColumn("candidate", F.when(c.isNotNull(), holed)))
    docs = docs.withColumn("k", F.regexp_replace("receipt_id", "-2$", "").cast("long")).withColumn("how", F.expr(_BROKEN_SQL))
    text = F.to_json(F.struct(F.when(how != "nameless", F.col("receipt_id")).alias("receipt_id"), F.when(how != "empty", F.col("results")).alias("results")))
    wrong = F.regexp_replace(text, r'"total":[0-9.E+-]+\},"line_items"', '"total":"abc"},"line_items"')
    return docs.select("k", "receipt_id", F.when(how == "cut", F.substring(text, 1, 40)).when(how == "typed", wrong).otherwise(text).alias("value"))


@query(RESOLVED_SQL + _passing_sql("agreed", "agreed_items") + f""",
docs AS (SELECT receipt_id, k, {_BROKEN_SQL} AS how FROM base),
fates AS (
  SELECT d.receipt_id, how, CASE WHEN how IN ('cut', 'empty', 'nameless', 'typed') OR how = 'incomplete' AND d.k % 23 <> 0 THEN 'quarantined'
         WHEN how = 'incomplete' THEN 'quarantined' WHEN p.receipt_id IS NULL THEN 'review_only'
         WHEN row_number() OVER (PARTITION BY p.content_hash ORDER BY d.receipt_id) = 1 THEN 'created' ELSE 'duplicate' END AS fate
  FROM docs d LEFT JOIN passing p ON p.receipt_id = d.receipt_id),
faults AS (
  SELECT CASE how WHEN 'cut' THEN 'no JSON' WHEN 'empty' THEN 'no results' ELSE 'receipt_id is required' END AS what FROM docs WHERE how IN ('cut', 'empty', 'nameless')
  UNION ALL
  SELECT '$.results[' || result_index || '].' || part || '.receipt.total is no double'
  FROM docs JOIN results USING (receipt_id), (VALUES ('candidate'), ('confidence')) parts(part) WHERE how = 'typed'
  UNION ALL
  SELECT 'receipt.total is required' FROM docs JOIN results USING (receipt_id) WHERE how = 'incomplete'
  UNION ALL
  SELECT 'receipt.date is required' FROM docs JOIN results USING (receipt_id) WHERE how = 'third' AND result_index = 2)
SELECT 'document' AS kind, CASE WHEN how = 'incomplete' AND receipt_id IN (SELECT receipt_id FROM failures) THEN 'without_candidate' ELSE fate END AS what, count(*) AS n
FROM fates GROUP BY ALL
UNION ALL SELECT 'fault', what, count(*) FROM faults GROUP BY ALL
UNION ALL SELECT 'document', 'all', count(*) FROM docs""")
def x2_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream with broken documents: every one that goes in has a fate, and every fault is stored with its reason."""
    folder = fresh_folder(spark, "letters")
    _write_source(_broken_documents(spark, sf_dir), f"{folder}/in")
    stream_ingest(spark, f"{folder}/in/*", f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    read = lambda name: read_table(spark, f"{folder}/tables", name)
    count = lambda df, kind: df.groupBy(F.lit(kind).alias("kind"), "what").agg(F.count(F.lit(1)).alias("n"))
    fate = count(read("documents").select(F.col("fate").alias("what")), "document")
    fault = count(read("quarantine").select(F.explode("errors").alias("what")), "fault")
    every = spark.read.text(f"{folder}/in/*").agg(F.lit("document").alias("kind"), F.lit("all").alias("what"), F.count(F.lit(1)).alias("n"))
    return fate.unionByName(fault).unionByName(every)


@query(SHAPED_SQL + """,
held AS (SELECT content_hash, min(receipt_id) AS id FROM passing WHERE k % 2 = 0 GROUP BY content_hash),
fresh AS (SELECT content_hash, min(receipt_id) AS id FROM passing GROUP BY content_hash)
SELECT p.receipt_id AS id, CASE WHEN h.id IS NOT NULL THEN h.id WHEN f.id <> p.receipt_id THEN f.id END AS existing_receipt_id
FROM passing p LEFT JOIN held h USING (content_hash) JOIN fresh f USING (content_hash)""")
def l5_history_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates of all receipts against a history stored in two batches and compacted, through its folders of fingerprints."""
    path, shaped = fresh_folder(spark, "history"), _shaped(spark, sf_dir)
    state = read_state(spark, path)
    for n in range(2):
        half = shaped.filter((F.col("k") % 4 == 2 * n) & (F.col("k") % 2 == 0))
        outcomes = materialised(ingest(half), "outcomes")
        bundle = emit(half, _no_reviews(half))
        state = store_batch(batch_tables(bundle, outcomes, resolve_stores(bundle.stores)), path, f"b{n}", state)
    compact(spark, path)
    receipts = shaped.select("record.id", "record.content_hash", F.lit(0).alias("arrival_seq"))
    return detect_duplicates(receipts, fingerprints(spark, path, read_state(spark, path), receipts)).select("id", "existing_receipt_id")


def _no_reviews(shaped: DataFrame) -> DataFrame:
    return shaped.select("receipt_id", no_reviews().alias("reviews"), no_reviews().alias("validation_reviews"))


@query(RESOLVED_SQL + _passing_sql("agreed", "agreed_items") + """
SELECT content_hash, count(*) AS n_photos, 1::BIGINT AS n_created, count(DISTINCT store_id) AS n_stores FROM passing GROUP BY content_hash""")
def s6_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches decided from the same state: the later one meets the receipts of the first and decides again."""
    path = fresh_folder(spark, "writers")
    rows = extractions_from_orders(spark, sf_dir)
    batches = [prepare(rows.filter(f"receipt_id {how} '%-2'")) for how in ("NOT LIKE", "LIKE")]
    seen = read_state(spark, path)
    decided = [load(b, None, None) for b in batches]
    for name, batch, result in zip(("one", "two"), batches, decided, strict=True):
        state = seen
        while True:
            try:
                store_batch(batch_tables(result.bundle, result.outcomes, result.new_stores), path, name, state)
                break
            except Conflict:
                state = read_state(spark, path)
                stores = read_table(spark, path, "stores", "name string, address string", state)
                result = load(batch, lambda hashes: fingerprints(spark, path, state, hashes), stores)  # noqa: B023
    outcomes, receipts = (read_table(spark, path, t) for t in ("outcomes", "receipts"))
    photos = outcomes.groupBy(F.coalesce("existing_receipt_id", "receipt_id").alias("id")).agg(F.count(F.lit(1)).alias("n_photos"))
    stores = read_table(spark, path, "stores").groupBy(F.col("id").alias("store_id")).agg(F.count(F.lit(1)).alias("n_stores"))
    created = receipts.groupBy("content_hash").agg(F.min("id").alias("id"), F.min("store_id").alias("store_id"), F.count(F.lit(1)).alias("n_created"))
    return created.join(photos, "id").join(stores, "store_id").select("content_hash", "n_photos", "n_created", "n_stores")


@query(RECONCILED_SQL + _validated_sql("agreed", "agreed_items") + """
SELECT extractor_source, flagged_reason, field_name, count(*) AS n_reviews, count(DISTINCT receipt_id) AS n_receipts,
       round(1e6 * avg(confidence_score)) / 1e6 AS mean_confidence
FROM (SELECT receipt_id, extractor_source, flagged_reason, field_name, confidence_score FROM all_reviews
      UNION ALL SELECT receipt_id, source, 'extraction_failed', 'receipt', 0.0 FROM failures
      UNION ALL SELECT receipt_id, 'validation', 'validation_failed', field_name, confidence_score FROM validation_rows) GROUP BY ALL""")
def q2_review_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of reviews kept up to date by three batches, one of them delivered twice."""
    path = fresh_folder(spark, "counts")
    docs = collect_documents(extractions_from_orders(spark, sf_dir)).select(F.to_json(F.struct("receipt_id", "results")).alias("value"), F.crc32(F.col("receipt_id").cast("binary")).alias("n"))
    docs = materialised(docs, "documents")
    for n in (0, 1, 1, 2):
        ingest_batch(docs.filter(F.col("n") % 3 == n).select("value"), path, f"b{n}")
    rows = merged_summary(read_table(spark, path, "review_counts"))
    return rows.withColumn("mean_confidence", F.round(1e6 * F.col("mean_confidence")) / 1e6)


@query("""-- over all prices
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, (l_extendedprice * 1000)::VARCHAR AS text FROM lineitem""")
def f1_float_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", float_text(F.col("l_extendedprice") * 1000).alias("text"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of disputed fields by source: how far the extractors agree."""
    return q1_review_summary(spark, sf_dir)
