"""Stores: one for each name and address, with an id that depends on these alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def store_id(name: Column, address: Column) -> Column:
    from receiptflow.functions.expr import stable_uuid

    return stable_uuid(F.lit("store"), name, address)


def resolve_stores(candidates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(id, name, address, phone, email, website, created_at) of the stores of ``candidates`` that ``existing`` lacks.

    Of several rows of a store the one of the smallest ``receipt_id`` gives phone, email and website. Rows without a
    name or an address give no store. A branch with a third of all receipts is one row after partial aggregation.
    """
    rest = F.struct("receipt_id", "phone", "email", "website")
    found = candidates.filter("name IS NOT NULL AND address IS NOT NULL").groupBy("name", "address").agg(F.min(rest).alias("r"))
    stores = found.select(
        store_id(F.col("name"), F.col("address")).alias("id"),
        "name",
        "address",
        "r.phone",
        "r.email",
        "r.website",
        F.lit(None).cast("timestamp").alias("created_at"),
    )
    return stores if existing is None else stores.join(existing.select("name", "address"), ["name", "address"], "left_anti")
