"""From resolved values to records: known columns and extras, line order, ids, the content fingerprint, the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from receiptflow import schemas
from receiptflow.functions.expr import float_text, stable_uuid
from receiptflow.operators.stores import store_id

KNOWN = tuple(f for f in schemas.RECEIPT if f != "extras")


def _json_value(name: str, value: Column) -> Column:
    """A scalar as JSON; ``extras`` is JSON already, and null where it is none."""
    if name == "extras":
        return F.to_json(F.try_parse_json(value))
    whole = F.to_json(F.struct(value.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def split_extras(resolved: DataFrame, flatten: bool = False) -> Column:
    """The fields of ``resolved.receipt`` without a column of their own, as a JSON object; null if there are none.

    An extractor's own ``extras`` is such a field, so it comes out nested under its name; ``flatten`` puts the members of
    an object beside the other fields instead. Null fields, and ``extras`` that are no JSON, are left out.
    """
    r = F.col("receipt")
    names = [f.name for f in resolved.schema["receipt"].dataType.fields if f.name not in (*KNOWN, "id", "store_id", "content_hash", "line_items")]
    parts = []
    for n in names:
        value = _json_value(n, r[f"`{n}`"] if "." in n else r[n])
        named = F.concat(F.to_json(F.array(F.lit(n))).substr(F.lit(2), F.lit(len(n) + 2)), F.lit(":"), value)
        if n == "extras" and flatten:
            inside = F.nullif(value.substr(F.lit(2), F.length(value) - 2), F.lit(""))
            named = F.when(value.startswith("{"), inside).otherwise(named)
        parts.append(named)
    if not parts:
        return F.lit(None).cast("string")
    body = F.concat_ws(",", *parts)
    return F.when(body != "", F.concat(F.lit("{"), body, F.lit("}")))


def content_hash(store: Column, transaction_ref: Column, date: Column, total: Column) -> Column:
    """The fingerprint by which a receipt is recognised again. None of the parts may be null."""
    return F.sha2(F.concat_ws("|", store, transaction_ref, date.cast("string"), float_text(total)), 256)


def shapeable(resolved: DataFrame, gate: str = "required", reviews: str = "reviews") -> Column:
    """Whether a receipt may become a record.

    ``required``: all required fields of store, receipt and items are there (an empty text counts as there).
    ``any_conflict``: besides, no field of store or receipt is disputed.
    """
    s, r = F.col("store"), F.col("receipt")
    ok = F.lit(True)
    for f in schemas.REQUIRED["store"]:
        ok = ok & s[f].isNotNull()
    for f in schemas.REQUIRED["receipt"]:
        ok = ok & r[f].isNotNull()
    holed = lambda f: F.exists("line_items", lambda x: x[f].isNull())
    for f in schemas.REQUIRED["line_item"]:
        ok = ok & ~holed(f)
    if gate == "any_conflict":
        of_section = (*schemas.STORE, *schemas.RECEIPT)
        disputed = F.exists(
            reviews, lambda x: (x["flagged_reason"] == "conflicting_extractions") & x["field_name"].isin(*of_section) & x["extractor_notes"].isNull()
        )
        ok = ok & ~disputed
    elif gate != "required":
        raise ValueError(f"no gate {gate!r}")
    return F.coalesce(ok, F.lit(False))


def shape(resolved: DataFrame, flatten_extras: bool = False) -> DataFrame:
    """(receipt_id, store, record, items) of rows that passed the gate; nested, so nothing moves.

    Ids, ``receipt_id``, ``store_id`` and ``line_order`` are given here; fields of these names in the input do not count.
    """
    s, r = F.col("store"), F.col("receipt")
    sid = store_id(s["name"], s["address"])
    store = F.struct(sid.alias("id"), *[s[f].alias(f) for f in schemas.STORE], F.lit(None).cast("timestamp").alias("created_at"))
    record = F.struct(
        F.col("receipt_id").alias("id"),
        sid.alias("store_id"),
        *[r[f].alias(f) for f in KNOWN],
        content_hash(sid, r["transaction_ref"], r["date"], r["total"]).alias("content_hash"),
        split_extras(resolved, flatten_extras).alias("extras"),
    )
    items = F.transform(
        "line_items",
        lambda x, i: F.struct(
            stable_uuid(F.lit("item"), F.col("receipt_id"), i + 1).alias("id"),
            F.col("receipt_id").alias("receipt_id"),
            *[x[f].alias(f) for f in schemas.ITEM],
            (i + 1).cast("int").alias("line_order"),
        ),
    )
    others = [c for c in resolved.columns if c not in ("store", "receipt", "line_items")]
    return resolved.select(*others, store.alias("store"), record.alias("record"), items.alias("items"))


def line_item_rows(shaped: DataFrame) -> DataFrame:
    """The items as a table."""
    return shaped.select(F.explode("items").alias("i")).select("i.*")
