"""Pairing line items of several results of a receipt by their descriptions.

Items are taken in order of results. An item joins the first open group of the same normalised text (open: without an
item of this result yet), else the open group whose text is most similar, above 0.9, else it opens a group. Where no
two different texts of different results can be that similar, or all results have the same texts, this is the same as
pairing the n-th occurrence of a text with the n-th in the other results, which needs no Python. Only other receipts go
to the helper.
"""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import lru_cache, reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from receiptflow.functions.expr import normal_text
from receiptflow.session import ship_package

SIMILAR = 0.9


def flat_items(results: Column) -> Column:
    """All items of a receipt in order: (result, pos, source, item, scores, key)."""
    return F.flatten(
        F.transform(
            results,
            lambda r, i: F.transform(
                r["candidate"]["line_items"],
                lambda x, j: F.struct(
                    i.alias("result"),
                    j.alias("pos"),
                    r["source"].alias("source"),
                    x.alias("item"),
                    F.get(r["confidence"]["line_items"], j).alias("scores"),
                    F.coalesce(normal_text(x["description"]), F.lit("")).alias("key"),
                ),
            ),
        )
    )


def starts(array: str, *fields: str) -> Column:
    """Where runs of elements that agree in ``fields`` begin in a sorted array of structs."""
    x, y = (lambda j: F.get(array, j)), (lambda j: F.get(array, j - 1))
    new = lambda j: reduce(or_, [x(j)[f] != y(j)[f] for f in fields], j == 0)
    places = F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, new)


def run_lengths(runs: str, array: str) -> Column:
    """The length of each run of ``starts``."""
    return F.transform(runs, lambda b, k: F.coalesce(F.get(runs, k + 1), F.size(array)) - b)


def with_occurrences(df: DataFrame) -> DataFrame:
    """Adds ``paired``: for each (text, n-th in its result) the group's number, from 1, in the order of ``items``.

    Two sorts, by text and result and then by text and occurrence, bring together what belongs together; runs of equal
    neighbours give the rest, so the work is that of sorting, however many items a receipt has. Adds ``texts``, too: for
    each text of each result how often it is there.
    """
    df = df.withColumn("s1", F.array_sort(F.transform("items", lambda x, i: F.struct(x["key"].alias("key"), x["result"].alias("result"), i.alias("i")))))
    df = df.withColumn("b1", starts("s1", "key", "result")).withColumn("n1", run_lengths("b1", "s1"))
    df = df.withColumn("nth", F.flatten(F.transform("n1", lambda n: F.sequence(F.lit(0), n - 1))))
    text = lambda b, k: F.struct(F.get("s1", b)["key"].alias("key"), F.get("n1", k).alias("n"))
    df = df.withColumn("texts", F.transform("b1", text))
    df = df.withColumn("s2", F.array_sort(F.transform("s1", lambda x, j: F.struct(x["key"].alias("key"), F.get("nth", j).alias("nth"), x["i"].alias("i")))))
    df = df.withColumn("b2", starts("s2", "key", "nth")).withColumn("n2", run_lengths("b2", "s2"))
    group = lambda b, k: F.struct(F.get("s2", b)["i"].alias("first"), b.alias("b"), F.get("n2", k).alias("n"))
    df = df.withColumn("ordered", F.array_sort(F.transform("b2", group)))
    member = lambda g, k: F.transform(F.slice("s2", g["b"] + 1, g["n"]), lambda x: F.struct(x["i"].alias("i"), (k + 1).alias("group")))
    df = df.withColumn("placed", F.array_sort(F.flatten(F.transform("ordered", member))))
    paired = F.transform("placed", lambda x: x["group"].cast("int"))
    return df.withColumn("paired", paired).drop("s1", "b1", "n1", "nth", "s2", "b2", "n2", "ordered", "placed")


def _may_be_similar(a: Column, b: Column) -> Column:
    """False only where two different texts cannot have a ratio above 0.9: by lengths, edit distance, then letters.

    The ratio is twice the letters matched in order over those of both, so it is at most what the letters that both have,
    in any order, would give.
    """
    both = F.length(a) + F.length(b)
    times = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))
    shared = F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, c: n + F.least(times(a, c), times(b, c)))
    return (10 * F.abs(F.length(a) - F.length(b)) < both) & (10 * F.levenshtein(a, b) < both) & (20 * shared > 9 * both)


def needs_helper(items: str, texts: str, firsts: str, uneven: str, n_results: Column) -> Column:
    """Whether similarity may matter to the pairing of a receipt's items.

    A text that every result has equally often finds its group unless another text takes it, so only pairs with a text that
    the results do not have equally often count.
    """
    key = lambda b: F.get(texts, b)["key"]
    near = F.exists(uneven, lambda u: F.exists(firsts, lambda b: (key(b) != u) & _may_be_similar(u, key(b))))
    return (n_results > 1) & (F.size(items) > 0) & near


def uneven_texts(texts: str, firsts: str, n_results: Column) -> Column:
    """The texts that not every result has equally often. ``texts`` are sorted by text, ``firsts`` are the starts of each."""
    size = lambda b, k: F.coalesce(F.get(firsts, k + 1), F.size(texts)) - b
    differ = lambda b, k: F.exists(F.slice(texts, b + 1, size(b, k)), lambda t: t["n"] != F.get(texts, b)["n"])
    found = F.transform(firsts, lambda b, k: F.when((size(b, k) != n_results) | differ(b, k), F.get(texts, b)["key"]))
    return F.filter(found, lambda x: x.isNotNull())


def exact_is_enough(items: str, n_results: Column) -> Column:
    """Whether pairing by text and occurrence gives what the greedy matching gives, by a look at all pairs of items.

    ``needs_helper`` finds fewer receipts in which it may not; this is the plain statement.

    A ratio above 0.9 means that the texts share all but a tenth of their letters, so their edit distance is below a
    tenth of their joint length: where that holds for no pair of different texts, no similarity can matter. Where
    every result has the same number of each text, an open group of the same text is always there.
    """
    close = F.exists(
        items,
        lambda a: F.exists(
            items,
            lambda b: (a["result"] < b["result"])
            & (a["key"] != b["key"])
            & (10 * F.abs(F.length(a["key"]) - F.length(b["key"])) < F.length(a["key"]) + F.length(b["key"]))
            & (10 * F.levenshtein(a["key"], b["key"]) < F.length(a["key"]) + F.length(b["key"])),
        ),
    )
    texts = lambda i: F.array_sort(F.transform(F.filter(items, lambda x: x["result"] == i), lambda x: x["key"]))
    alike = F.forall(F.sequence(F.lit(0), n_results - 1), lambda i: texts(i) == texts(F.lit(0)))
    # a single result has no item to pair another with
    return (F.size(items) == 0) | (n_results <= 1) | F.when(n_results > 0, alike).otherwise(F.lit(True)) | ~close


@lru_cache(maxsize=100_000)
def similarity(new: str, old: str) -> float:
    """Ratio of matching letters of a new text to a group's text; the order of the two matters."""
    return SequenceMatcher(None, new, old).ratio()


def greedy_groups(texts: list[str], results: list[int]) -> list[int]:
    """The group, from 1, of each item of a receipt."""
    keys: list[str] = []
    filled: list[set[int]] = []
    out = []
    for raw, result in zip(texts, results, strict=True):
        key = (raw or "").strip().casefold()
        free = [g for g in range(len(keys)) if result not in filled[g]]
        chosen = next((g for g in free if keys[g] == key), None)
        if chosen is None:
            best = SIMILAR
            for g in free:
                most = 2 * min(len(key), len(keys[g])) / max(1, len(key) + len(keys[g]))
                if most > best and (ratio := similarity(key, keys[g])) > best:
                    best, chosen = ratio, g
        if chosen is None:
            chosen = len(keys)
            keys.append(key)
            filled.append(set())
        filled[chosen].add(result)
        out.append(chosen + 1)
    return out


def _helper():
    @F.pandas_udf("array<int>")
    def match(texts: pd.Series, results: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else greedy_groups(list(t), [int(r) for r in q]) for t, q in zip(texts, results, strict=True)])

    # not to be copied into the lambdas of later expressions, where Spark could not evaluate it
    return match.asNondeterministic()


def match_items(gathered: DataFrame, but: str | None = None) -> DataFrame:
    """Rows with ``results`` get ``items`` (see ``flat_items``), ``group_of`` (each item's group, from 1) and ``exact``.

    The helper sees the texts of those receipts only for which pairing by occurrence may differ, which are not ``exact``;
    for the others it gets null. A receipt is one row, so this moves no data. Rows for which the column ``but`` is true get
    no items: the caller knows their groups.
    """
    ship_package(gathered.sparkSession)
    items = flat_items(F.col("results"))
    df = with_occurrences(gathered.withColumn("items", items if but is None else F.when(~F.col(but), items).otherwise(F.slice(items, 1, 0))))
    df = df.withColumn("firsts", starts("texts", "key")).withColumn("uneven", uneven_texts("texts", "firsts", F.size("results")))
    df = df.withColumn("exact", ~needs_helper("items", "texts", "firsts", "uneven", F.size("results")))
    ask = lambda part: F.when(~F.col("exact"), F.transform("items", part))
    helped = _helper()(ask(lambda x: x["item"]["description"]), ask(lambda x: x["result"]))
    return df.withColumn("group_of", F.when(F.col("exact"), F.col("paired")).otherwise(helped)).drop("paired", "texts", "firsts", "uneven")
