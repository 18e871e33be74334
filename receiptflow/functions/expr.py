"""Scalar expressions that several operators share; all are built-in Spark functions."""

from __future__ import annotations

import sys
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.schemas import REVIEW

TOLERANCE = 0.01
#: Gaps of up to so many tolerances are as good as none.
NEGLIGIBLE = 5


def float_text(x: Column) -> Column:
    """A double as Python spells it: ``150.0``, ``0.1``, with an exponent below 0.0001 and from 1e16 on: ``5e-05``.

    The digits are Java's, which in rare cases of 17 digits are not the shortest.
    """
    java = x.cast("string")
    size = F.abs(x)
    exact = F.regexp_replace(x.try_cast("decimal(38,18)").cast("string"), r"(\.[0-9]+?)0*$", "$1")
    part = lambda i: F.regexp_extract(java, r"^(-?[0-9]+(?:\.[0-9]+)?)E(-?)([0-9]+)$", i)
    power = F.lpad(part(3), F.greatest(F.lit(2), F.length(part(3))), F.lit("0"))
    mantissa = F.regexp_replace(part(1), r"\.0$", "")
    scientific = F.concat(mantissa, F.lit("e"), F.when(part(2) == "-", "-").otherwise("+"), power)
    odd = F.when(F.isnan(x), "nan").when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf")).when(x == 0, java)
    return F.coalesce(odd, F.when((size < 1e-4) | (size >= 1e16), scientific), exact, java)


def as_text(x: Column, kind: T.DataType) -> Column:
    """A field's value as a review spells it; null stays null."""
    if isinstance(kind, T.DoubleType):
        return float_text(x)
    return x if isinstance(kind, T.StringType) else x.cast("string")


def stable_uuid(*parts: Column) -> Column:
    """A text of the shape of a UUID that is a function of ``parts``; null counts as a value of its own."""
    marked = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    h = F.sha2(F.concat_ws("\x1f", *marked), 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *cut)


@lru_cache(maxsize=1)
def _foldings() -> tuple[dict[str, str], dict[str, str]]:
    """Letters that case folding replaces by one letter, and by several."""
    folded = {c: c.casefold() for c in map(chr, range(sys.maxunicode + 1)) if c.casefold() != c}
    return {c: f for c, f in folded.items() if len(f) == 1}, {c: f for c, f in folded.items() if len(f) > 1}


def case_folded(text: Column) -> Column:
    """Full case folding, as for comparing without regard to case: ``Straße`` and ``STRASSE`` become ``strasse``.

    Letters that fold to one letter are translated, those that fold to several (``ß``, ``ŉ``, ligatures) are looked up, and
    only in texts that have any; of plain ASCII lower case is the same.
    """
    single, several = _foldings()
    one = F.translate(text, "".join(single), "".join(single.values()))
    # the letters of each text that folds to several are few: only these are replaced
    found = F.array_distinct(F.regexp_extract_all(one, F.lit(f"([{''.join(several)}])")))
    table = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    whole = F.aggregate(found, one, lambda t, c: F.replace(t, c, table[c]))
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), F.lower(text)).when(F.size(found) > 0, whole).otherwise(one)


def normal_text(description: Column) -> Column:
    """Without white space around it and case folded. White space is Unicode's and the separators U+001C to U+001F."""
    return case_folded(F.regexp_replace(description, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+\z", ""))


def compensated_sum(values: Column) -> Column:
    """The sum of an array of doubles in its order, nulls left out; what each addition rounds off is summed beside it.

    A sum that overflows or holds an infinity stays what plain addition gives.
    """

    def step(a: Column, x: Column) -> Column:
        t = a["sum"] + x
        lost = F.when(F.abs(a["sum"]) >= F.abs(x), (a["sum"] - t) + x).otherwise((x - t) + a["sum"])
        return F.struct(t.alias("sum"), (a["lost"] + lost).alias("lost"))

    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("lost"))
    finite = lambda c: (c - c) == 0
    known = F.filter(values, lambda x: x.isNotNull())
    return F.aggregate(known, start, step, lambda a: F.when(finite(a["lost"]), a["sum"] + a["lost"]).otherwise(a["sum"]))


def mismatch_confidence(actual: Column, expected: Column) -> Column:
    """How far a value that does not add up may still be trusted: 0.99 for small gaps, less with the relative gap."""
    gap = F.abs(actual - expected)
    reference = F.when(expected != 0, F.abs(expected)).otherwise(gap)
    scaled = F.greatest(F.lit(0.0), F.least(F.lit(0.99), F.lit(1.0) - gap / reference))
    return F.when(gap <= F.lit(NEGLIGIBLE * TOLERANCE), F.lit(0.99)).otherwise(scaled)


def review(
    field: str | Column, source: Column, value: Column | None, confidence: Column, reason: str, notes: Column | None = None
) -> Column:
    """A review entry, as an element of an array column."""
    none = F.lit(None).cast("string")
    return F.struct(
        (F.lit(field) if isinstance(field, str) else field).alias("field_name"),
        source.alias("extractor_source"),
        (none if value is None else value).alias("extracted_value"),
        confidence.alias("confidence_score"),
        F.lit(reason).alias("flagged_reason"),
        (none if notes is None else notes).alias("extractor_notes"),
    )


def no_reviews() -> Column:
    return F.array().cast(T.ArrayType(REVIEW))


def present(entries: list[Column]) -> Column:
    """The entries that are not null, as an array."""
    return F.filter(F.array(*entries), lambda x: x.isNotNull())


def missing(x: Column) -> Column:
    """Null or an empty text."""
    return x.isNull() | (x.cast("string") == "")
