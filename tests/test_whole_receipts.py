"""Queries over all receipts, those with fuzzy items too, against plain Python and against their SQL."""

from collections import Counter, defaultdict

import duckdb
import pytest

from receiptflow import queries, schemas
from receiptflow.adapter import extractions_from_orders
from tests.test_receipts import plain_groups

SF = "/root/testdata/sf0.001"


def text(value):
    return None if value is None else str(value)


def restated(results):
    """(item places, reviews by section and items, resolved fields, resolved items) of one receipt's results."""
    fields, resolved = [], {}
    for section, names in (("store", schemas.STORE), ("receipt", schemas.RECEIPT)):
        for f in names:
            values = [r.candidate[section][f] for r in results]
            resolved[f] = values[0] if len(set(values)) == 1 else None
            if len(set(values)) > 1:
                fields += [(f, r.source, text(v), r.confidence[section].get(f, 0.0), "conflicting_extractions", None) for r, v in zip(results, values, strict=True)]
    groups = defaultdict(list)
    flat = [(i, j, r.source, x, r.confidence.line_items[j]) for i, r in enumerate(results) for j, x in enumerate(r.candidate.line_items)]
    for m, g in zip(flat, plain_groups([[x.description for x in r.candidate.line_items] for r in results]), strict=True):
        groups[g].append(m)
    of_items, items = [], []
    for g, members in sorted(groups.items()):
        note = f"line item {g}"
        there = {m[0] for m in members}
        of_items += [("missing_line_item", r.source, None, 0.0, "conflicting_extractions", note) for i, r in enumerate(results) if i not in there]
        if len(members) == 1 and len(results) > 1:
            _, _, source, x, scores = members[0]
            of_items.append(("line_item", source, x.description, scores.get("description", 0.0), "low_confidence", note))
        for f in schemas.ITEM:
            if len({m[3][f] for m in members}) > 1:
                of_items += [(f, s, text(x[f]), scores.get(f, 0.0), "conflicting_extractions", note) for _, _, s, x, scores in members]
        items.append({f: members[0][3][f] if len({m[3][f] for m in members}) == 1 else None for f in schemas.ITEM})
    return groups, fields, of_items, resolved, items


def faults(resolved, items):
    """Names of the fields that validation flags."""
    out = [f for s in ("store", "receipt") for f in schemas.REQUIRED[s] if resolved[f] in (None, "")]
    for x in items:
        out += [f for f in schemas.REQUIRED["line_item"] if x[f] in (None, "")]
        if None not in (x["quantity"], x["unit_price"], x["line_total"]) and abs(x["quantity"] * x["unit_price"] - x["line_total"]) >= 0.01:
            out.append("line_total")
    expected = resolved["subtotal"]
    if expected is None and resolved["total"] is not None:
        expected = resolved["total"] - (resolved["consumption_tax"] or 0.0)
    if expected is not None:
        if items and abs(sum_in_order(items) - expected) >= 0.01:
            out.append("line_item")
        if not items and abs(expected) >= 0.01:
            out.append("missing_line_item")
    return out


def sum_in_order(items):
    s = 0.0
    for x in items:
        s += x["line_total"] or 0.0
    return s


@pytest.fixture(scope="module")
def extractions(spark):
    return extractions_from_orders(spark, SF).drop("k").collect()


@pytest.fixture(scope="module")
def plain(extractions):
    by = defaultdict(list)
    for r in extractions:
        if r.candidate is not None:
            by[r.receipt_id].append(r)
    return {rid: restated(sorted(rs, key=lambda r: r.result_index)) for rid, rs in by.items()}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("lineitem", "part", "orders", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def of_items(plain, keep):
    return Counter((rid, *v) for rid, x in plain.items() for v in x[2] if keep(v[0]))


ROWWISE = {
    "r8_item_positions": lambda plain: Counter((rid, s, j + 1, g) for rid, x in plain.items() for g, ms in x[0].items() for _, j, s, _, _ in ms),
    "r9_missing_item_reviews": lambda plain: of_items(plain, lambda f: f == "missing_line_item"),
    "r10_uncorroborated_item_reviews": lambda plain: of_items(plain, lambda f: f == "line_item"),
    "r11_single_item_passthrough": lambda plain: Counter((rid, g, *[ms[0][3][f] for f in schemas.ITEM]) for rid, x in plain.items() for g, ms in x[0].items() if len(ms) == 1),
    "r12_reconcile_item_fields": lambda plain: of_items(plain, lambda f: f not in ("line_item", "missing_line_item")),
    "r13_reconcile": lambda plain: Counter((rid, None, len(x[4]), len(x[1]) + len(x[2])) for rid, x in plain.items()),
}


def equals_sql(con, name, df):
    rows = [tuple(r) for r in df.collect()]
    said = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(rows) == Counter(said)
    return rows


@pytest.mark.parametrize("name", ROWWISE)
def test_all_receipts_and_sql(spark, con, plain, name):
    rows = equals_sql(con, name, queries.QUERIES[name](spark, SF))
    bare = [(r[0], None, *r[2:]) for r in rows] if name == "r13_reconcile" else rows
    assert Counter(bare) == ROWWISE[name](plain)


def test_emit_and_summary_count_all_reviews(spark, plain, extractions):
    want = Counter({("extract", "receipt", "extraction_failed"): sum(r.candidate is None for r in extractions)})
    summary = defaultdict(list)
    for rid, (_, fields, items, resolved, lines) in plain.items():
        want.update(("reconcile", v[0], v[4]) for v in fields + items)
        want.update(("validate", f, "validation_failed") for f in faults(resolved, lines))
        for v in fields + items:
            summary[v[1], v[4], v[0]].append((rid, v[3]))
    assert {tuple(r)[:3]: r.n_reviews for r in queries.e1_emit(spark, SF).collect()} == dict(want)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in queries.flagship(spark, SF).collect()}
    assert got.keys() == summary.keys()
    for k, v in summary.items():
        assert got[k] == (len(v), len({rid for rid, _ in v}), pytest.approx(sum(c for _, c in v) / len(v), abs=2e-6))


def with_holes(rid, resolved, lines):
    """The faults that ``resolved_from_orders`` puts in."""
    k = int(rid.removesuffix("-2"))
    resolved = dict(resolved)
    if k % 41 == 0:
        resolved["name"] = ""
    if k % 43 == 0:
        resolved["transaction_ref"] = None
    if k % 53 == 0 and resolved["subtotal"] is not None:
        resolved["subtotal"] += 5
    return resolved, [x | ({"quantity": None} if k % 47 == 0 and i == 0 else {}) for i, x in enumerate(lines)]


def passes(resolved, lines):
    asked = [resolved[f] for s in ("store", "receipt") for f in schemas.REQUIRED[s]] + [x[f] for x in lines for f in schemas.REQUIRED["line_item"]]
    return None not in asked


RESOLVED = {
    "v9_validate": lambda plain: Counter((rid, f) for rid, x in plain.items() for f in faults(*with_holes(rid, *x[3:]))),
    "h4_shapeable": lambda plain: Counter((rid, ok := passes(*with_holes(rid, *x[3:])), ok and not x[1]) for rid, x in plain.items()),
    "l4_ingest": lambda plain: Counter(rid for rid, x in plain.items() if passes(*with_holes(rid, *x[3:]))),
}


@pytest.mark.parametrize("name", RESOLVED)
def test_resolved_from_all_results_and_sql(spark, con, plain, name):
    rows = equals_sql(con, name, queries.QUERIES[name](spark, SF))
    bare = [r[0] if name == "l4_ingest" else r[:2] if name == "v9_validate" else r for r in rows]
    assert Counter(bare) == RESOLVED[name](plain)


def test_pipeline_counts(spark, con, plain, extractions):
    """Restated: what passes is stored once for each order's fingerprint; the rest is left to review."""
    (got,) = equals_sql(con, "p1_run_pipeline", queries.QUERIES["p1_run_pipeline"](spark, SF))
    stored = Counter(rid.removesuffix("-2") for rid, x in plain.items() if passes(*x[3:]))
    receipts = len({r.receipt_id for r in extractions})
    assert got == (receipts, len(stored), sum(stored.values()) - len(stored), 0, len(plain) - sum(stored.values()), receipts - len(plain), 0)


def test_stream_takes_all_results(spark, plain):
    """A receipt whose results dispute a required field is not stored."""
    stored = Counter(rid.removesuffix("-2") for rid, x in plain.items() if passes(*x[3:]))
    assert len(stored) < len({rid.removesuffix("-2") for rid in plain})
    got = queries.x1_stream_ingest(spark, SF).collect()
    assert len(got) == len(stored) and sum(r.n_photos for r in got) == sum(stored.values()) and {r.n_created for r in got} == {1}
