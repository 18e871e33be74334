"""Consistency of resolved records: what is required, and sums that have to agree. Projections only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from receiptflow import schemas
from receiptflow.functions.expr import TOLERANCE, compensated_sum, mismatch_confidence, missing, no_reviews, present, review


def _row(field: str, confidence: Column | None = None) -> Column:
    return review(field, F.lit("validation"), None, F.lit(0.0) if confidence is None else confidence, "validation_failed")


def required_store() -> Column:
    return present([F.when(missing(F.col("store")[f]), _row(f)) for f in schemas.REQUIRED["store"]])


def required_receipt() -> Column:
    return present([F.when(missing(F.col("receipt")[f]), _row(f)) for f in schemas.REQUIRED["receipt"]])


def required_line_item(item: Column) -> Column:
    return present([F.when(missing(item[f]), _row(f)) for f in schemas.REQUIRED["line_item"]])


def line_arithmetic(item: Column) -> Column:
    """A review if quantity times price is not the line's total; none where one of them is null."""
    product = item["quantity"] * item["unit_price"]
    off = F.abs(product - item["line_total"]) >= F.lit(TOLERANCE)
    return present([F.when(off, _row("line_total", mismatch_confidence(item["line_total"], product)))])


def expected_sum() -> Column:
    """What the lines should add up to: the subtotal, else the total without the tax on consumption."""
    r = F.col("receipt")
    return F.coalesce(r["subtotal"], r["total"] - F.coalesce(r["consumption_tax"], F.lit(0.0)))


def sum_mismatch() -> Column:
    total = compensated_sum(F.transform("line_items", lambda x: x["line_total"]))
    off = (F.size("line_items") > 0) & (F.abs(total - expected_sum()) >= F.lit(TOLERANCE))
    return present([F.when(off, _row("line_item", mismatch_confidence(total, expected_sum())))])


def no_items() -> Column:
    off = (F.size("line_items") == 0) & (F.abs(expected_sum()) >= F.lit(TOLERANCE))
    return present([F.when(off, _row("missing_line_item"))])


def validate(resolved: DataFrame) -> DataFrame:
    """``resolved`` with ``validation_reviews``: store, receipt, each item (required, then arithmetic), then the sum.

    The receipt's items are added in their order, with what rounding loses added at the end. Missing items count as an empty list.
    """
    df = resolved.withColumn("line_items", F.coalesce("line_items", F.slice(F.array(F.struct(*_null_item())), F.lit(1), F.lit(0))))
    items = F.flatten(F.transform("line_items", lambda x: F.concat(required_line_item(x), line_arithmetic(x))))
    rows = F.concat(required_store(), required_receipt(), items, sum_mismatch(), no_items())
    return df.withColumn("validation_reviews", F.coalesce(rows, no_reviews()))


def _null_item() -> list[Column]:
    return [F.lit(None).cast(kind).alias(f) for f, kind in schemas.ITEM.items()]
