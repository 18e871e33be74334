"""Rules of reconciliation, validation, shaping and loading on hand-made receipts, and against plain Python."""

import datetime
import random
import sys
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from receiptflow import schemas
from receiptflow.functions.expr import case_folded, compensated_sum, float_text, mismatch_confidence, normal_text
from receiptflow.operators.checks import check_candidates, check_confidence_alignment, check_records
from receiptflow.operators.load import detect_duplicates, ingest, payload_errors
from receiptflow.operators.matching import greedy_groups, match_items
from receiptflow.operators.reconcile import gather, reconcile
from receiptflow.operators.shape import shape, shapeable, split_extras
from receiptflow.operators.stores import resolve_stores
from receiptflow.operators.validate import validate
from receiptflow.plans.pipeline import outcome_counts, run_pipeline
from receiptflow.schemas import EXTRACTION

DAY = datetime.date(2025, 11, 3)


def result(rid, index, source="a", items=(), confidence=None, scores=None, store=None, **receipt):
    base = {"source_image_id": "till-4.jpg", "transaction_ref": "T/7731", "date": DAY, "total": 84.0} | receipt
    items = [dict(zip(schemas.ITEM, x, strict=True)) for x in items]
    return {
        "receipt_id": rid,
        "result_index": index,
        "source": source,
        "candidate": {"store": {"name": "Shop", "address": "Road 1"} | (store or {}), "receipt": base, "line_items": items},
        "confidence": {"store": {}, "receipt": confidence or {}, "line_items": [{} for _ in items] if scores is None else scores},
        "failure": None,
    }


def failed(rid, index, source="b"):
    row = {"field_name": "receipt", "extractor_source": source, "confidence_score": 0.0, "flagged_reason": "extraction_failed", "status": "pending"}
    return {"receipt_id": rid, "result_index": index, "source": source, "candidate": None, "confidence": None, "failure": row}


ITEM = ("Jasmine rice 5kg", 2.0, 42.0, 84.0)
CASES = {
    "one": ([result("one", 0, items=[ITEM])], []),
    "agree": ([result("agree", k, s, [ITEM]) for k, s in enumerate("abc")], []),
    "total": (
        [result("total", 0, "a", [ITEM], {"total": 0.9}), result("total", 1, "b", [ITEM], {"total": 0.4}, total=94.0)],
        [("total", "a", "84.0", 0.9, None), ("total", "b", "94.0", 0.4, None)],
    ),
    "majority": (
        [result("majority", 0, "a", [ITEM]), result("majority", 1, "b", [ITEM]), result("majority", 2, "c", [ITEM], total=999.0)],
        [("total", "a", "84.0", 0.0, None), ("total", "b", "84.0", 0.0, None), ("total", "c", "999.0", 0.0, None)],
    ),
    "absent": (
        [result("absent", 0, "a", [ITEM], store={"phone": "5"}), result("absent", 1, "b", [ITEM])],
        [("phone", "a", "5", 0.0, None), ("phone", "b", None, 0.0, None)],
    ),
    "quantity": (
        [result("quantity", 0, "a", [ITEM]), result("quantity", 1, "b", [(ITEM[0], 3.0, *ITEM[2:])])],
        [("quantity", "a", "2.0", 0.0, "line item 1"), ("quantity", "b", "3.0", 0.0, "line item 1")],
    ),
    "missing": (
        [result("missing", 0, "a", [ITEM, ("Lamp oil", 1.0, 5.0, 5.0)], scores=[{}, {"description": 0.7}]), result("missing", 1, "b", [ITEM])],
        [("missing_line_item", "b", None, 0.0, "line item 2"), ("line_item", "a", "Lamp oil", 0.7, "line item 2")],
    ),
    "typo": (
        [result("typo", 0, "a", [ITEM]), result("typo", 1, "b", [("Jasmin rice 5kg", *ITEM[1:])])],
        [("description", "a", "Jasmine rice 5kg", 0.0, "line item 1"), ("description", "b", "Jasmin rice 5kg", 0.0, "line item 1")],
    ),
    "near": (
        [result("near", 0, "a", [("Salt", 1.0, 1.0, 1.0)]), result("near", 1, "b", [("Malt", 1.0, 1.0, 1.0)])],
        [
            ("missing_line_item", "b", None, 0.0, "line item 1"),
            ("line_item", "a", "Salt", 0.0, "line item 1"),
            ("missing_line_item", "a", None, 0.0, "line item 2"),
            ("line_item", "b", "Malt", 0.0, "line item 2"),
        ],
    ),
    "order": ([result("order", 0, "a", [ITEM, ("Soap", 1.0, 1.0, 1.0)]), result("order", 1, "b", [("Soap", 1.0, 1.0, 1.0), ITEM])], []),
    "twice": (
        [
            result("twice", 0, "a", [("Soda", 1.0, 2.0, 2.0), ("Soda", 2.0, 2.0, 4.0)]),
            result("twice", 1, "b", [("Soda", 1.0, 2.0, 2.0), ("Soda", 3.0, 2.0, 4.0)]),
        ],
        [("quantity", "a", "2.0", 0.0, "line item 2"), ("quantity", "b", "3.0", 0.0, "line item 2")],
    ),
    "same_name": (
        [result("same_name", 0, "a", [ITEM]), result("same_name", 1, "a", [])],
        [("missing_line_item", "a", None, 0.0, "line item 1"), ("line_item", "a", "Jasmine rice 5kg", 0.0, "line item 1")],
    ),
    "partial": (
        [result("partial", 0, "a", [ITEM]), result("partial", 1, "b", [(ITEM[0], 3.0, *ITEM[2:])]), result("partial", 2, "c", [])],
        [
            ("missing_line_item", "c", None, 0.0, "line item 1"),
            ("quantity", "a", "2.0", 0.0, "line item 1"),
            ("quantity", "b", "3.0", 0.0, "line item 1"),
        ],
    ),
}


@pytest.fixture(scope="module")
def validated(spark):
    rows = [r for results, _ in CASES.values() for r in results]
    df = validate(reconcile(gather(spark.createDataFrame(rows, EXTRACTION).repartition(3))))
    return {r.receipt_id: r for r in df.collect()}


@pytest.mark.parametrize("name", CASES)
def test_reconcile_cases(validated, name):
    row = validated[name]
    got = [(v.field_name, v.extractor_source, v.extracted_value, v.confidence_score, v.extractor_notes) for v in row.reviews]
    assert got == CASES[name][1]
    assert row.n_results == len(CASES[name][0])
    disputed = {v[0] for v in CASES[name][1]}
    assert (row.receipt.total is None) == ("total" in disputed)


def test_unresolved_fields_are_missing_for_validation(validated):
    fields = lambda n: [v.field_name for v in validated[n].validation_reviews]
    assert fields("one") == [] and fields("total") == ["total"] and fields("quantity") == ["quantity"]
    assert fields("typo") == ["description"]


def plain_groups(results):
    """Greedy matching restated."""
    groups, out = [], []
    for index, texts in enumerate(results):
        for text in texts:
            key = text.strip().casefold()
            free = [g for g in groups if index not in g["in"]]
            pick = next((g for g in free if g["key"] == key), None)
            if pick is None:
                scored = [(SequenceMatcher(None, key, g["key"]).ratio(), -i, g) for i, g in enumerate(groups) if index not in g["in"]]
                best = max(scored, key=lambda s: s[:2], default=None)
                pick = best[2] if best and best[0] > 0.9 else None
            if pick is None:
                pick = {"key": key, "in": set(), "n": len(groups) + 1}
                groups.append(pick)
            pick["in"].add(index)
            out.append(pick["n"])
    return out


NAMES = ["jasmine rice 5kg", "jasmin rice 5kg", "Jasmine rice 50kg ", "salt", "malt", "straße 10 in der stadt", "STRASSE 10 in der stadt", "old ring 12", "cold ring 12"]


def test_matching_equals_greedy_on_random_receipts(spark):
    rng = random.Random(8)
    rows, texts = [], {}
    for k in range(400):
        rid = f"r{k}"
        texts[rid] = [[rng.choice(NAMES[: rng.choice([4, 9])]) for _ in range(rng.randint(0, 5))] for _ in range(rng.randint(1, 3))]
        rows += [result(rid, i, f"s{i}", [(t, 1.0, 1.0, 1.0) for t in ts]) for i, ts in enumerate(texts[rid])]
    got = match_items(gather(spark.createDataFrame(rows, EXTRACTION))).select("receipt_id", "group_of", "exact").collect()
    assert len(got) == 400 and {r.exact for r in got} == {True, False}
    for r in got:
        assert r.group_of == plain_groups(texts[r.receipt_id]), texts[r.receipt_id]
        flat = [(t, i) for i, ts in enumerate(texts[r.receipt_id]) for t in ts]
        assert greedy_groups([t for t, _ in flat], [i for _, i in flat]) == r.group_of


def test_confidence_of_mismatches(spark):
    rows = [(301.0, 300.0), (9000.0, 300.0), (1.05, 1.0), (1.04, 1.0), (0.2, 0.0), (300.0, 300.0)]
    df = spark.createDataFrame(rows, "a double, e double")
    got = [r[0] for r in df.select(mismatch_confidence(F.col("a"), F.col("e"))).collect()]
    assert got == pytest.approx([0.99, 0.0, 0.95, 0.99, 0.0, 0.99])


def test_float_text_is_python_text(spark):
    rng = random.Random(1)
    values = [0.0, 1.0, 1e7, 0.0005, 1234567.125, 300.0] + [round(rng.uniform(-1e6, 1e6), rng.randint(0, 6)) for _ in range(2000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", float_text(F.col("v")).alias("t")).collect()
    assert all(r.t == repr(r.v) for r in got if r.v == 0 or abs(r.v) >= 1e-4)


def test_checks(spark):
    nan = result("nan", 0, total=float("nan"))
    holed = result("holed", 0, store={"name": None})
    uneven = result("uneven", 0, items=[ITEM, ITEM], scores=[{}])
    nothing = failed("nothing", 0) | {"failure": None}
    nobody = [result(None, 0), failed(None, 0), result("x", None), result("y", 0, source=None), result("z", 0, extras="{no")]
    df = spark.createDataFrame([result("ok", 0, items=[ITEM]), nan, holed, uneven, nothing, failed("f", 0), *nobody], EXTRACTION)
    fine, odd = check_candidates(df)
    assert {r.receipt_id for r in fine.collect()} == {"ok", "uneven", "f"}
    errors = {r.receipt_id or r.candidate is None: r.errors for r in odd.collect()}
    assert errors["holed"] == ["store.name is required"] and errors["nothing"] == ["neither a candidate nor a failure"]
    assert errors[False] == errors[True] == ["receipt_id is required"] and errors["z"] == ["receipt.extras is no JSON"]
    assert errors["x"] == ["result_index is required"] and errors["y"] == ["source is required"]
    fine, odd = check_confidence_alignment(fine)
    assert odd.collect()[0].errors == ["a: line items and maps of scores differ in number, 2 to 1"] and fine.count() == 2
    with pytest.raises(Exception, match="line item"):
        check_confidence_alignment(df.filter("receipt_id = 'uneven'"), "failfast")[0].collect()
    reviews = spark.createDataFrame([("1", "r", "total", "a", 1.5, "low_confidence", "done")], "id string, receipt_id string, field_name string, extractor_source string, confidence_score double, flagged_reason string, status string")
    assert check_records(reviews, "review").collect()[0].errors == ["confidence_score is not between 0 and 1", "status is unknown"]


def test_shape_gate_and_extras(spark):
    rows = [result("x", 0, items=[ITEM], extras='{"points": 50}'), result("y", 0, items=[ITEM]), result("y", 1, "b", [ITEM], total=1.0)]
    df = validate(reconcile(gather(spark.createDataFrame(rows, EXTRACTION))))
    assert {r.receipt_id: r.ok for r in df.select("receipt_id", shapeable(df).alias("ok")).collect()} == {"x": True, "y": False}
    row = shape(df.filter(shapeable(df, "any_conflict"))).collect()[0]
    assert row.record.extras == '{"extras":{"points":50}}' and row["items"][0].line_order == 1 and len(row.record.content_hash) == 64
    assert df.select(split_extras(df, flatten=True).alias("e"), "receipt_id").filter("receipt_id = 'x'").collect()[0].e == '{"points":50}'
    wider = df.withColumn("receipt", F.col("receipt").withField("bonus", F.lit(7)))
    assert wider.select(split_extras(wider).alias("e"), "receipt_id").filter("receipt_id = 'y'").collect()[0].e == '{"bonus":7}'


def test_duplicates_and_errors(spark):
    df = spark.createDataFrame([("a", "h", 2), ("b", "h", 1), ("c", "g", 1)], "id string, content_hash string, arrival_seq int")
    assert {r.id: r.existing_receipt_id for r in detect_duplicates(df).collect()} == {"a": "b", "b": None, "c": None}
    old = spark.createDataFrame([("z", "g")], "id string, content_hash string")
    assert {r.id: r.existing_receipt_id for r in detect_duplicates(df, old).collect()} == {"a": "b", "b": None, "c": "z"}
    rows = reconcile(gather(spark.createDataFrame([result("p", 0, items=[ITEM]), result("q", 0, items=[ITEM])], EXTRACTION)))
    shaped = shape(rows)
    none = shaped.withColumn("record", F.when(F.col("receipt_id") != "p", F.col("record")))
    got = none.select("receipt_id", payload_errors(F.col("store"), F.col("record")).alias("e")).collect()
    assert {r.receipt_id: r.e for r in got} == {"p": ["store and receipt are both required"], "q": []}
    assert {r.receipt_id: r.status for r in ingest(shaped).collect()} == {"p": "created", "q": "duplicate"}


def test_stores_of_one_chain_stay_apart(spark):
    rows = [("1", "A", "x", None, None, None), ("2", "A", "x", "5", None, None), ("3", "A", "y", None, None, None), ("4", None, "y", None, None, None)]
    df = spark.createDataFrame(rows, "receipt_id string, name string, address string, phone string, email string, website string")
    assert resolve_stores(df).count() == 2
    assert resolve_stores(df, df.filter("address = 'y'").select("name", "address")).select("address").collect() == [("x",)]


def test_pipeline_counts_add_up_and_do_not_depend_on_partitions(spark):
    rows = [r for results, _ in CASES.values() for r in results] + [failed("f", 0), failed("one", 1), result("late", 0, items=[ITEM])]
    seen = []
    for n in (1, 5):
        df = spark.createDataFrame(rows, EXTRACTION).repartition(n)
        done = run_pipeline(df)
        counts = outcome_counts(done).collect()[0]
        assert counts.n_receipts == sum(counts[1:]) and counts.n_without_candidate == 1
        assert done.bundle.reviews.filter("origin = 'extract'").count() == 2
        seen.append((counts, sorted(r.id for r in done.bundle.reviews.collect()), sorted(map(tuple, done.outcomes.select("receipt_id", "status").collect()))))
    assert seen[0] == seen[1]
    empty = spark.createDataFrame([], EXTRACTION)
    assert run_pipeline(empty).outcomes.count() == 0


def test_float_text_with_exponents(spark):
    rng = random.Random(3)
    values = [5e-05, -5e-05, 1e-19, 1.5e-300, 1e16, 12345678901234567890.0, 1e22, 9999999999999998.0, 0.0001, 0.0, -0.0, float("inf"), float("-inf"), float("nan")]
    values += [rng.randint(1, 999) * 10.0**k for k in range(-12, 16)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(float_text(F.col("v"))).collect()
    assert [r[0] for r in got] == [str(v) for v in values]


def test_case_folding_of_all_letters(spark):
    letters = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF]
    rows = [("".join(letters[i : i + 64]),) for i in range(0, len(letters), 64)] + [(c,) for c in letters if c.casefold() != c.lower()]
    rows += [("Straße STRASSE ŉ ﬃ İ Σας",), ("",), (" \x1c\u00a0\u3000Reis\x1f\n",), ("\x1c",), (" \n\n",), (None,)]
    got = spark.createDataFrame(rows, "t string").select("t", case_folded(F.col("t")), normal_text(F.col("t"))).collect()
    assert len(got) == len(rows)
    for t, folded, normal in got:
        assert folded == (None if t is None else t.casefold())
        assert normal == (None if t is None else t.strip().casefold())


def test_sums_are_compensated(spark):
    rng = random.Random(5)
    lists = [[rng.choice((0.1, 0.01, 1e9, 33.33, -1e9, 1e16, 1.0, None)) for _ in range(rng.randint(0, 40))] for _ in range(500)]
    lists += [[0.1] * 10, [1e16, 1.0, -1e16], [float("inf"), 1.0], [1e308, 1e308, -1e308], [None], []]
    got = spark.createDataFrame([(x,) for x in lists], "x array<double>").select(compensated_sum(F.col("x"))).collect()
    assert [r[0] for r in got] == [float(sum(v for v in x if v is not None)) for x in lists]
    assert any(a != b for a, b in zip([r[0] for r in got], map(plain_sum, lists), strict=True))


def plain_sum(values):
    s = 0.0
    for v in values:
        s += v or 0.0
    return s
