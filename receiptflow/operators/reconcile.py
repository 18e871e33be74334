"""Agreement across extractors: a field is resolved if all results of a receipt give the same value.

No majority and no confidence decides; null is a value like others. Every value of a disputed field becomes a review.
All of it works on one row for each receipt that holds its results as an array, so the only shuffle is ``gather``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from receiptflow import schemas
from receiptflow.functions.expr import as_text, no_reviews, review, stable_uuid
from receiptflow.operators.matching import match_items, run_lengths, starts

SECTIONS = {"store": schemas.STORE, "receipt": schemas.RECEIPT}


def gather(extractions: DataFrame) -> DataFrame:
    """(receipt_id, results): the candidates of each receipt in order of ``result_index``, then ``source``, then content.

    A receipt has a handful of results, so no key is hot. Receipts whose extractors all failed have no row. Rows without
    a ``receipt_id`` belong to no receipt; ``check_candidates`` sets them aside.
    """
    one = F.struct("result_index", "source", "candidate", "confidence")
    gathered = extractions.filter("candidate IS NOT NULL AND receipt_id IS NOT NULL").groupBy("receipt_id").agg(F.collect_list(one).alias("results"))
    return gathered.withColumn("results", in_order("results"))


def in_order(results: str) -> Column:
    """The results of a receipt by index, then source, then content, which is compared only where two agree in both."""
    places = F.array_sort(F.transform(results, lambda r, i: F.struct(r["result_index"], r["source"], i.alias("place"))))
    plain = F.transform(places, lambda p: F.get(results, p["place"]))
    pairs = F.array_distinct(F.transform(results, lambda r: F.struct(r["result_index"], r["source"])))
    return F.when(F.size(pairs) == F.size(results), plain).otherwise(F.array_sort(results, _by_content))


def _by_content(a: Column, b: Column) -> Column:
    """Which of two results comes first; the content decides between results of one index and source."""
    out = F.when(a["result_index"] < b["result_index"], -1).when(a["result_index"] > b["result_index"], 1)
    out = out.when(a["source"] < b["source"], -1).when(a["source"] > b["source"], 1)
    x, y = (F.to_json(r["candidate"]) for r in (a, b))
    return out.when(x < y, -1).when(x > y, 1).otherwise(0)


def field_confidence(scores: Column, field: str) -> Column:
    """The confidence a result gives a field; 0 where it gives none."""
    return F.coalesce(scores[field], F.lit(0.0))


def _canonical(field: str, value: Column) -> Column:
    """JSON objects are compared by content, not by spelling."""
    return F.coalesce(F.to_json(F.try_parse_json(value)), value) if field == "extras" else value


def reconcile_section(gathered: DataFrame, section: str) -> DataFrame:
    """Adds the resolved ``section`` (a struct, disputed fields null) and ``<section>_reviews``."""
    fields = SECTIONS[section]
    get = lambda r, f: _canonical(f, r["candidate"][section][f])
    values = lambda f: F.array_distinct(F.transform("results", lambda r: get(r, f))).alias(f)
    df = gathered.withColumn("__distinct", F.struct(*map(values, fields)))
    agreed = lambda f: F.size(F.col("__distinct")[f]) == 1
    resolved = F.struct(*[F.when(agreed(f), F.get(F.col("__distinct")[f], F.lit(0))).alias(f) for f in fields])

    def disputed(f: str) -> Column:
        return F.when(
            F.size(F.col("__distinct")[f]) > 1,
            F.transform(
                "results",
                lambda r: review(
                    f,
                    r["source"],
                    as_text(get(r, f), fields[f]),
                    field_confidence(r["confidence"][section], f),
                    "conflicting_extractions",
                ),
            ),
        ).otherwise(no_reviews())

    return df.withColumns({section: resolved, f"{section}_reviews": F.concat(*[disputed(f) for f in fields])}).drop("__distinct")


def reconcile_store(gathered: DataFrame) -> DataFrame:
    return reconcile_section(gathered, "store")


def reconcile_receipt(gathered: DataFrame) -> DataFrame:
    return reconcile_section(gathered, "receipt")


def item_groups(matched: DataFrame) -> DataFrame:
    """Adds ``groups``: for each group of matched items its members in order of results, groups in first-seen order.

    Groups are numbered as they are first seen, so sorting items by group and place leaves each group's members in a run.
    """
    df = matched.withColumn("by_group", F.array_sort(F.transform("group_of", lambda g, i: F.struct(g.alias("group"), i.alias("i")))))
    df = df.withColumn("runs", starts("by_group", "group")).withColumn("sizes", run_lengths("runs", "by_group"))
    members = lambda b, k: F.transform(F.slice("by_group", b + 1, F.get("sizes", k)), lambda x: F.get("items", x["i"]))
    return df.withColumn("groups", F.transform("runs", members)).drop("by_group", "runs", "sizes")


def _values(members: Column, field: str) -> Column:
    return F.array_distinct(F.transform(members, lambda m: m["item"][field]))


def missing_items(members: Column, note: Column) -> Column:
    """Reviews for the results, by index, that lack an item others have."""
    absent = F.filter(
        F.sequence(F.lit(0), F.size("results") - 1), lambda i: ~F.exists(members, lambda m: m["result"] == i)
    )
    return F.transform(
        absent, lambda i: review("missing_line_item", F.get("results", i)["source"], None, F.lit(0.0), "conflicting_extractions", note)
    )


def uncorroborated_item(members: Column, note: Column) -> Column:
    """A review for an item that one of several results has."""
    only = F.get(members, F.lit(0))
    row = review(
        "line_item", only["source"], only["item"]["description"], field_confidence(only["scores"], "description"), "low_confidence", note
    )
    return F.when((F.size(members) == 1) & (F.size("results") > 1), F.array(row)).otherwise(no_reviews())


def disputed_item_fields(members: Column, note: Column) -> Column:
    """Reviews for the fields on which the members of a group differ."""

    def one(f: str) -> Column:
        rows = F.transform(
            members,
            lambda m: review(
                f, m["source"], as_text(m["item"][f], schemas.ITEM[f]), field_confidence(m["scores"], f), "conflicting_extractions", note
            ),
        )
        return F.when(F.size(_values(members, f)) > 1, rows).otherwise(no_reviews())

    return F.concat(*[one(f) for f in schemas.ITEM])


def alike(results: str) -> Column:
    """Whether all results have the same items in the same order, without nulls and zeros.

    Then the n-th items are a group each that agrees in all, whatever their texts. Zeros are left out as those of
    unlike sign are equal, but not one value.
    """
    of = lambda r: r["candidate"]["line_items"]
    first = of(F.get(results, F.lit(0)))
    plain = F.forall(first, lambda x: x["description"].isNotNull() & (x["quantity"] != 0) & (x["unit_price"] != 0) & (x["line_total"] != 0))
    return F.coalesce(plain & F.forall(results, lambda r: of(r) == first), F.lit(False))


def reconcile_items(gathered: DataFrame) -> DataFrame:
    """Adds ``line_items`` (resolved, in group order) and ``line_items_reviews``.

    Of results that are ``alike``, which most are, the items are those of any; only the others' are matched.
    """
    df = item_groups(match_items(gathered.withColumn("alike", alike("results")), "alike"))
    note = lambda p: F.concat(F.lit("line item "), p + 1)
    reviews = F.flatten(
        F.transform(
            "groups", lambda g, p: F.concat(missing_items(g, note(p)), uncorroborated_item(g, note(p)), disputed_item_fields(g, note(p)))
        )
    )
    agreed = lambda g, f: F.when(F.size(_values(g, f)) == 1, F.get(_values(g, f), F.lit(0))).alias(f)
    resolved = F.transform("groups", lambda g: F.struct(*[agreed(g, f) for f in schemas.ITEM]))
    first = F.get("results", F.lit(0))["candidate"]["line_items"]
    given = F.transform(first, lambda x: F.struct(*[x[f].alias(f) for f in schemas.ITEM]))
    df = df.withColumns({"line_items": F.when(F.col("alike"), given).otherwise(resolved), "line_items_reviews": reviews})
    return df.drop("groups", "items", "group_of", "exact", "alike")


def reconcile(gathered: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(receipt_id, n_results, store, receipt, line_items, reviews): reviews of store, receipt, then items.

    Columns named in ``carry`` come along.
    """
    df = reconcile_items(reconcile_receipt(reconcile_store(gathered)))
    reviews = F.concat("store_reviews", "receipt_reviews", "line_items_reviews")
    return df.select("receipt_id", F.size("results").alias("n_results"), "store", "receipt", "line_items", reviews.alias("reviews"), *carry)


def review_rows(df: DataFrame, column: str, origin: str) -> DataFrame:
    """A row for each entry of a review array, with an id that depends on the receipt and the place only.

    The outer explode keeps Spark from inferring a filter on the array, which would evaluate all of its expression
    once more below.
    """
    rows = df.select("receipt_id", F.posexplode_outer(column).alias("seq", "r")).filter("seq IS NOT NULL")
    return rows.select(
        stable_uuid(F.col("receipt_id"), F.lit(origin), F.col("seq")).alias("id"),
        "receipt_id",
        F.lit(None).cast("string").alias("line_item_id"),
        "r.field_name",
        "r.extractor_source",
        "r.extracted_value",
        "r.confidence_score",
        "r.flagged_reason",
        F.lit("pending").alias("status"),
        "r.extractor_notes",
        F.lit(None).cast("string").alias("reviewed_value"),
        F.lit(None).cast("string").alias("resolution_notes"),
        F.lit(None).cast("string").alias("reviewed_by"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.lit(origin).alias("origin"),
        "seq",
    )
