"""Receipts derived from the driver's order tables: clean results, perturbed ones, total failures, second photos.

``extractions_from_orders`` builds them with Spark; ``FLAT_SQL`` says the same as plain SQL for DuckDB, one row for each
result and each item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from receiptflow import schemas
from receiptflow.operators.reconcile import gather, reconcile


def photographed(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` of orders by ``receipt_id``: those of which there is a second photo come twice."""
    copies = F.when(F.col(key) % 37 == 0, F.array(F.lit(""), F.lit("-2"))).otherwise(F.array(F.lit("")))
    return rows.withColumn("receipt_id", F.explode(F.transform(copies, lambda c: F.concat(F.col(key).cast("string"), c))))


def photos_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(receipt_id, k, date, name, address, items, subtotal, consumption_tax, total): one row for each photo of an order.

    Orders and their lines meet by ``receipt_id``, so the results made of a row are dealt out by it from the start and
    do not move again to be gathered.
    """
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    line, part = read("lineitem"), read("part").select("p_partkey", "p_name", "p_brand")
    line = line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_tax")
    line = line.join(part, F.col("l_partkey") == F.col("p_partkey"))
    price = F.round(100 * F.col("l_extendedprice") / F.col("l_quantity")) / 100
    total = F.when(F.col("l_partkey") % 10 == 0, F.col("l_extendedprice")).otherwise(F.round(100 * F.col("l_quantity") * price) / 100)
    place = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    row = F.struct(
        *place,
        F.concat("p_name", F.lit(" "), "p_brand").alias("description"),
        F.col("l_quantity").cast("double").alias("quantity"),
        price.alias("unit_price"),
        total.alias("line_total"),
        "l_tax",
    )
    baskets = photographed(line, "l_orderkey").groupBy("receipt_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    add = lambda f: F.aggregate("rows", F.lit(0.0), f)  # noqa: E731  whole cents, exact in any order
    baskets = baskets.select(
        "receipt_id",
        F.transform("rows", lambda x: F.struct(*[x[f].alias(f) for f in schemas.ITEM])).alias("items"),
        add(lambda s, x: s + F.round(100 * x["line_total"] * x["l_tax"])).alias("tax"),
        add(lambda s, x: s + F.round(100 * x["line_total"])).alias("net"),
    )
    customer = read("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = read("nation").select("n_nationkey", "n_name")
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = photographed(rows, "o_orderkey").join(baskets, "receipt_id", "left")
    k = F.col("o_orderkey")
    return rows.select(
        "receipt_id",
        k.alias("k"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("c_mktsegment").alias("name"),
        F.col("n_name").alias("address"),
        F.coalesce("items", F.array().cast("array<struct<description:string,quantity:double,unit_price:double,line_total:double>>")).alias("items"),
        F.when(k % 5 != 0, F.col("net") / 100).alias("subtotal"),
        (F.col("tax") / 100).alias("consumption_tax"),
        F.coalesce((F.col("net") + F.col("tax")) / 100, F.col("o_totalprice").cast("double")).alias("total"),
    )


def _perturbed(items: Column, k: Column) -> Column:
    rows = F.when((k % 13 == 0) & (F.size(items) > 0), F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0)))).otherwise(items)
    cut = lambda d: F.concat(F.substring(d, 1, 2), F.substring(d, 4, 1000))
    rows = F.transform(
        rows,
        lambda x, i: F.struct(
            F.when((k % 17 == 0) & (i == 0), cut(x["description"])).otherwise(x["description"]).alias("description"),
            F.when((k % 11 == 0) & (i == 0), x["quantity"] + 1).otherwise(x["quantity"]).alias("quantity"),
            x["unit_price"].alias("unit_price"),
            x["line_total"].alias("line_total"),
        ),
    )
    return F.when(k % 19 == 0, F.reverse(rows)).otherwise(rows)


def extractions_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows (the schema of extractions, with the order key ``k``)."""
    photos = photos_with_items(spark, sf_dir)
    k = F.col("k")
    one = lambda n, source, total, phone, items, of_total, of_text, failed: F.struct(
        F.lit(n).alias("result_index"),
        F.lit(source).alias("source"),
        total.alias("total"),
        phone.alias("phone"),
        items.alias("items"),
        F.lit(of_total).alias("of_total"),
        F.lit(of_text).alias("of_text"),
        failed.alias("failed"),
    )
    none, no = F.lit(None).cast("string"), F.lit(False)
    results = [
        one(0, "ocr-a", F.col("total"), none, F.col("items"), 0.9, 0.8, no),
        one(
            1,
            "vision-b",
            F.when(k % 7 == 0, F.col("total") + 10).otherwise(F.col("total")),
            F.when(k % 31 == 0, F.concat(F.lit("555-"), k.cast("string"))),
            _perturbed(F.col("items"), k),
            0.4,
            0.6,
            k % 23 == 0,
        ),
    ]
    third = one(2, "cloud-c", F.col("total"), none, F.col("items"), 0.7, 0.5, no)
    chosen = F.when(k % 3 == 0, F.array(*results, third)).otherwise(F.array(*results))
    rows = photos.withColumn("r", F.explode(chosen))
    value = {
        "source_image_id": F.concat(F.lit("img_"), "receipt_id"),
        "transaction_ref": F.concat(F.lit("INV-"), k.cast("string")),
        "date": F.col("date"),
        "subtotal": F.col("subtotal"),
        "consumption_tax": F.col("consumption_tax"),
        "total": F.col("r.total"),
    }
    store_value = {"name": F.col("name"), "address": F.col("address"), "phone": F.col("r.phone")}
    of = lambda fields, given: F.struct(*[given.get(f, F.lit(None).cast(t)).alias(f) for f, t in fields.items()])
    candidate = F.struct(
        of(schemas.STORE, store_value).alias("store"), of(schemas.RECEIPT, value).alias("receipt"), F.col("r.items").alias("line_items")
    )
    empty = F.create_map().cast("map<string,double>")
    scores = F.transform("r.items", lambda x: F.create_map(F.lit("description"), F.col("r.of_text")))
    confidence = F.struct(
        empty.alias("store"), F.create_map(F.lit("total"), F.col("r.of_total")).alias("receipt"), scores.alias("line_items")
    )
    failure = F.struct(
        F.lit("receipt").alias("field_name"),
        F.col("r.source").alias("extractor_source"),
        none.alias("extracted_value"),
        F.lit(0.0).alias("confidence_score"),
        F.lit("extraction_failed").alias("flagged_reason"),
        F.lit("pending").alias("status"),
        none.alias("extractor_notes"),
    )
    return rows.select(
        "receipt_id",
        "r.result_index",
        "r.source",
        F.when(~F.col("r.failed"), candidate).alias("candidate"),
        F.when(~F.col("r.failed"), confidence).alias("confidence"),
        F.when(F.col("r.failed"), failure).alias("failure"),
        "k",
    )


def resolved_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts resolved from all their results, some with faults: no store name, no reference, no quantity, a wrong subtotal."""
    df = reconcile(gather(extractions_from_orders(spark, sf_dir))).withColumn("k", F.regexp_replace("receipt_id", "-2$", "").cast("long"))
    k = F.col("k")
    none = F.lit(None).cast("string")
    store = F.col("store").withField("name", F.when(k % 41 == 0, F.lit("")).otherwise(F.col("store.name")))
    receipt = F.col("receipt").withField("transaction_ref", F.when(k % 43 == 0, none).otherwise(F.col("receipt.transaction_ref")))
    points = F.concat(F.lit('{"loyalty_points":'), k.cast("string"), F.lit("}"))
    receipt = receipt.withField("extras", F.when(k % 4 == 0, points))
    receipt = receipt.withField("subtotal", F.when(k % 53 == 0, F.col("receipt.subtotal") + 5).otherwise(F.col("receipt.subtotal")))
    hole = lambda x, i: F.when((k % 47 == 0) & (i == 0), F.lit(None).cast("double")).otherwise(x["quantity"])
    items = F.transform("line_items", lambda x, i: x.withField("quantity", hole(x, i)))
    return df.withColumns({"store": store, "receipt": receipt, "line_items": items})


#: The same receipts for DuckDB: ``results``, ``ritems`` (items of results) and ``failures``.
FLAT_SQL = """
WITH RECURSIVE priced AS (
  SELECT l_orderkey AS k, l_partkey, l_extendedprice, l_tax, p_name || ' ' || p_brand AS description,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS pos,
         count(*) OVER (PARTITION BY l_orderkey) AS n, l_quantity::DOUBLE AS quantity,
         round(100 * l_extendedprice / l_quantity) / 100 AS unit_price
  FROM lineitem JOIN part ON l_partkey = p_partkey),
lines AS (
  SELECT *, CASE WHEN l_partkey % 10 = 0 THEN l_extendedprice ELSE round(100 * quantity * unit_price) / 100 END AS line_total FROM priced),
sums AS (
  SELECT k, sum(round(100 * line_total * l_tax)) AS tax, sum(round(100 * line_total)) AS net FROM lines GROUP BY k),
copies AS (SELECT o_orderkey AS k, '' AS copy FROM orders UNION ALL SELECT o_orderkey, '-2' FROM orders WHERE o_orderkey % 37 = 0),
base AS (
  SELECT o_orderkey AS k, o_orderkey::VARCHAR || copy AS receipt_id, 'img_' || o_orderkey || copy AS source_image_id,
         'INV-' || o_orderkey AS transaction_ref, o_orderdate::DATE AS date, c_mktsegment AS name, n_name AS address,
         CASE WHEN o_orderkey % 5 <> 0 THEN net / 100 END AS subtotal, tax / 100 AS consumption_tax,
         coalesce((net + tax) / 100, o_totalprice::DOUBLE) AS total
  FROM orders JOIN copies c ON o_orderkey = c.k JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN sums ON sums.k = o_orderkey),
results AS (
  SELECT * EXCLUDE (total), total AS total, NULL::VARCHAR AS phone, 0 AS result_index, 'ocr-a' AS source, 0.9::DOUBLE AS of_total, 0.8::DOUBLE AS of_text FROM base
  UNION ALL
  SELECT * EXCLUDE (total), CASE WHEN k % 7 = 0 THEN total + 10 ELSE total END, CASE WHEN k % 31 = 0 THEN '555-' || k END, 1, 'vision-b', 0.4, 0.6
  FROM base WHERE k % 23 <> 0
  UNION ALL
  SELECT * EXCLUDE (total), total, NULL, 2, 'cloud-c', 0.7, 0.5 FROM base WHERE k % 3 = 0),
failures AS (SELECT receipt_id, k, 1 AS result_index, 'vision-b' AS source FROM base WHERE k % 23 = 0),
ritems AS (
  SELECT r.receipt_id, r.k, r.result_index, r.source, r.of_text, l.pos AS pos, l.description, l.quantity, l.unit_price, l.line_total
  FROM results r JOIN lines l ON r.k = l.k WHERE r.result_index <> 1
  UNION ALL
  SELECT r.receipt_id, r.k, 1, r.source, r.of_text,
         CASE WHEN r.k % 19 = 0 THEN n - (CASE WHEN r.k % 13 = 0 THEN 1 ELSE 0 END) + 1 - l.pos ELSE l.pos END,
         CASE WHEN r.k % 17 = 0 AND l.pos = 1 THEN substr(description, 1, 2) || substr(description, 4) ELSE description END,
         CASE WHEN r.k % 11 = 0 AND l.pos = 1 THEN quantity + 1 ELSE quantity END, unit_price, line_total
  FROM results r JOIN lines l ON r.k = l.k WHERE r.result_index = 1 AND NOT (r.k % 13 = 0 AND l.pos = n))"""

#: All items' groups (``members``), by text and occurrence or, for the receipts of ``fuzzy``, by the greedy matching:
#: ``spans`` takes the longest common stretch of two texts and goes on left and right of it, ``picked`` gives the items
#: of a receipt to groups one by one.
GROUPS_SQL = """,
keyed AS MATERIALIZED (
  SELECT *, lower(trim(description)) AS key, row_number() OVER (PARTITION BY receipt_id ORDER BY result_index, pos) AS n FROM ritems),
near AS MATERIALIZED (
  SELECT DISTINCT a.receipt_id, b.key AS new, a.key AS old FROM keyed a
  JOIN keyed b ON a.receipt_id = b.receipt_id AND a.result_index < b.result_index AND a.key <> b.key
  WHERE 10 * levenshtein(a.key, b.key) < length(a.key) + length(b.key)),
lists AS (
  SELECT r.receipt_id, r.result_index, coalesce(list(i.key ORDER BY i.key) FILTER (WHERE i.key IS NOT NULL), []) AS keys
  FROM results r LEFT JOIN keyed i ON r.receipt_id = i.receipt_id AND r.result_index = i.result_index GROUP BY ALL),
alike AS MATERIALIZED (SELECT receipt_id, count(*) AS n_results, count(DISTINCT keys) = 1 AS same FROM lists GROUP BY receipt_id),
fuzzy AS MATERIALIZED (SELECT receipt_id FROM alike SEMI JOIN near USING (receipt_id) WHERE NOT same),
pairs AS MATERIALIZED (SELECT DISTINCT new, old FROM near SEMI JOIN fuzzy USING (receipt_id)),
letters AS (
  SELECT new, old, i, j FROM (
    SELECT new, old, i, unnest(range(length(old))) AS j FROM (SELECT new, old, unnest(range(length(new))) AS i FROM pairs))
  WHERE new[i + 1] = old[j + 1]),
stretches AS MATERIALIZED (
  SELECT new, old, i, j, max(i) OVER (PARTITION BY new, old, i - j, i - nth) - i + 1 AS k
  FROM (SELECT *, row_number() OVER (PARTITION BY new, old, i - j ORDER BY i) AS nth FROM letters)),
spans(new, old, alo, ahi, blo, bhi, size) AS (
  SELECT new, old, 0::BIGINT, length(new), 0::BIGINT, length(old), 0::BIGINT FROM pairs
  UNION ALL
  SELECT new, old, CASE side WHEN 0 THEN alo ELSE i + k END, CASE side WHEN 0 THEN i ELSE ahi END,
         CASE side WHEN 0 THEN blo ELSE j + k END, CASE side WHEN 0 THEN j ELSE bhi END, CASE side WHEN 0 THEN k ELSE 0 END
  FROM (
    SELECT *, best // 1000000 AS k, 999 - (best // 1000) % 1000 AS i, 999 - best % 1000 AS j FROM (
      SELECT s.new, s.old, alo, ahi, blo, bhi, max((least(k, ahi - i, bhi - j) * 1000 + 999 - i) * 1000 + 999 - j) AS best
      FROM spans s JOIN stretches t ON s.new = t.new AND s.old = t.old AND i >= alo AND i < ahi AND j >= blo AND j < bhi
      GROUP BY s.new, s.old, alo, ahi, blo, bhi)), (VALUES (0), (1)) sides(side)),
ratios AS MATERIALIZED (
  SELECT new, old, 2.0::DOUBLE * sum(size) / (length(new) + length(old)) AS ratio FROM spans GROUP BY new, old),
known AS MATERIALIZED (
  SELECT receipt_id, map(list(new || chr(31) || old), list(ratio)) AS sims FROM near SEMI JOIN fuzzy USING (receipt_id) JOIN ratios USING (new, old)
  WHERE ratio > 0.9::DOUBLE GROUP BY receipt_id),
picked(receipt_id, n, chosen, groups) AS (
  SELECT receipt_id, 0::BIGINT, 0::BIGINT, []::STRUCT(key VARCHAR, filled INTEGER[])[] FROM fuzzy
  UNION ALL
  SELECT receipt_id, n + 1, chosen,
         CASE WHEN chosen > len(groups) THEN list_append(groups, {'key': key, 'filled': [result_index]})
         ELSE list_transform(groups, lambda g, p: CASE WHEN p = chosen THEN {'key': g.key, 'filled': list_append(g.filled, result_index)} ELSE g END) END
  FROM (
    SELECT *, coalesce(list_filter(free, lambda g: groups[g].key = key)[1],
                       -(list_sort(list_transform(list_filter(free, lambda g: sims[key || chr(31) || groups[g].key] > 0.9::DOUBLE),
                           lambda g: {'r': sims[key || chr(31) || groups[g].key], 'g': -g}), 'DESC')[1].g), len(groups) + 1) AS chosen
    FROM (
      SELECT p.receipt_id, p.n, groups, i.key, i.result_index, sims,
             list_filter(range(1, len(groups) + 1), lambda g: NOT list_contains(groups[g].filled, i.result_index)) AS free
      FROM picked p JOIN keyed i ON i.receipt_id = p.receipt_id AND i.n = p.n + 1 LEFT JOIN known w ON w.receipt_id = p.receipt_id))),
nth AS (
  SELECT k.*, row_number() OVER (PARTITION BY k.receipt_id, result_index, key ORDER BY pos) AS nth FROM keyed k ANTI JOIN fuzzy USING (receipt_id)),
firsts AS (SELECT receipt_id, key, nth, min(n) AS first FROM nth GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY receipt_id ORDER BY first) AS group_pos FROM firsts),
placed AS (
  SELECT receipt_id, n, group_pos FROM nth JOIN numbered USING (receipt_id, key, nth)
  UNION ALL SELECT receipt_id, n, chosen FROM picked WHERE n > 0),
members AS MATERIALIZED (
  SELECT k.*, p.group_pos, a.n_results, count(*) OVER (PARTITION BY k.receipt_id, p.group_pos) AS members
  FROM keyed k JOIN placed p ON k.receipt_id = p.receipt_id AND k.n = p.n JOIN alike a ON a.receipt_id = k.receipt_id)"""

_AGREED = "CASE WHEN count(DISTINCT {0}) = 1 AND count({0}) = count(*) THEN any_value({0}) END AS {0}"
#: Receipts resolved from all their results (``agreed``, ``agreed_items``), and with the faults that
#: ``resolved_from_orders`` puts in (``res0``, ``items0``).
RESOLVED_SQL = GROUPS_SQL + f""",
agreed AS MATERIALIZED (
  SELECT k, receipt_id, source_image_id, transaction_ref, date, name, address, subtotal, consumption_tax, {_AGREED.format("total")}, NULL::VARCHAR AS extras
  FROM results GROUP BY k, receipt_id, source_image_id, transaction_ref, date, name, address, subtotal, consumption_tax),
agreed_items AS MATERIALIZED (
  SELECT receipt_id, k, group_pos AS pos, max(group_pos) OVER (PARTITION BY receipt_id) AS n,
         {", ".join(map(_AGREED.format, ("description", "quantity", "unit_price", "line_total")))}
  FROM members GROUP BY receipt_id, k, group_pos),
res0 AS MATERIALIZED (
  SELECT * REPLACE (CASE WHEN k % 43 <> 0 THEN transaction_ref END AS transaction_ref, CASE WHEN k % 41 = 0 THEN '' ELSE name END AS name,
                    CASE WHEN k % 53 = 0 THEN subtotal + 5 ELSE subtotal END AS subtotal,
                    CASE WHEN k % 4 = 0 THEN '{{"loyalty_points":' || k || '}}' END AS extras) FROM agreed),
items0 AS MATERIALIZED (SELECT * REPLACE (CASE WHEN k % 47 = 0 AND pos = 1 THEN NULL ELSE quantity END AS quantity) FROM agreed_items)"""
