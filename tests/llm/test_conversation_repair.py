"""Conversation repair against a shortest path over all edits."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from receiptflow.llm import conversation_repair
from receiptflow.llm.conversation_repair import audit_conversations, cheapest_edits, repair_turns
from receiptflow.llm.queries import op12_conversation_repair
from tests.llm.sql import equals_sql

SPACE = " \t\n\x0b\x0c\r"


def brute(codes):
    """(cost, audit) by the places between turns alone: no targets, no bands."""
    goes = {"start": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"start": (0, ""), "a": (0, "")}

    def with_inserts(best):
        for _ in range(4):
            for p, ways in goes.items():
                for c, q in ways.items():
                    if c != "s" and q in best:
                        way = (best[q][0] + 2, "I" + best[q][1])
                        best[p] = min(best.get(p, way), way)
        return best

    best = with_inserts(best)
    for code in reversed(codes):
        new = {}
        own, cut, gone = "suax"[code & 3], bool(code & 4), bool(code & 8)
        for p, ways in goes.items():
            ways_here = [(best[p][0] + 3, "D" + best[p][1])] if p in best else []
            if not gone:
                for c, q in ways.items():
                    if q in best:
                        if c == own:
                            ways_here.append((best[q][0] + cut, "K" + best[q][1]))
                        if c != "s":
                            ways_here.append((best[q][0] + 2 + cut, "R" + best[q][1]))
            if ways_here:
                new[p] = min(ways_here)
        best = with_inserts(new)
    return best["start"]


def test_all_short_and_random_longer_ones():
    for n in range(4):
        for k in range(10**n):
            codes = bytes([0, 1, 2, 3, 4, 5, 6, 7, 8, 9][int(c)] for c in str(k).zfill(n)) if n else b""
            assert cheapest_edits(codes) == brute(codes), codes
    rng = random.Random(1)
    for n in list(range(4, 40)) * 12:
        codes = bytes(rng.choice([0, 1, 2, 3]) + rng.choice([0, 0, 4, 8]) for _ in range(n))
        assert cheapest_edits(codes) == brute(codes), codes


def test_blocks_change_nothing(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(conversation_repair, "_BLOCK", 3)
    for n in list(range(12)) * 30:
        codes = bytes(rng.choice([0, 1, 2, 3]) + rng.choice([0, 0, 4, 8]) for _ in range(n))
        assert cheapest_edits(codes) == brute(codes), codes


def test_a_conversation_of_many_turns():
    rng = random.Random(3)
    codes = bytes((1 + k % 2 if rng.random() < 0.8 else rng.randint(0, 3)) + rng.choice([0, 0, 0, 4, 8]) for k in range(8000))
    assert cheapest_edits(codes) == brute(codes)


def report(rows):
    """Rows (turn, role, text) of one conversation, as they are after damage: all columns by plain loops."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha256(r[2].encode()).digest()))
    seen, codes, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        body = text.strip(SPACE)
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        codes.append({"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + (8 if fault in (0, 1) else 4 if fault == 2 else 0))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = brute(codes)
    left, at, place = [], 0, ""
    for letter in audit:
        if letter in "IR":
            role = "assistant" if place == "u" else "user"
        if letter == "I":
            left.append(f"{role}:")
        else:
            if letter != "D":
                role = rows[at][1] if letter == "K" else role
                left.append(f"{role}:{rows[at][2]}")
            at += 1
        if letter != "D":
            place = role[0]
    return (gaps, *counts, illegal, cost, audit, sha256("\n".join(left).encode()).hexdigest()), left


def random_table(rng):
    texts = ["Yes.", "No!", "what", " \t", "", None, "long text, then. ", "end?\n", "é.", "x" * 20]
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    rows = []
    for c in [None, *range(60)]:
        for t in range(rng.randint(1, 12)):
            for _ in range(rng.choice([1, 1, 1, 2])):
                rows.append((c, rng.choice([t, t, t, t * 3, None]), rng.choice(roles[: rng.choice([3, 7])]), rng.choice(texts)))
    return rows + rows[:5]


def test_operators_against_plain_loops(spark):
    rng = random.Random(4)
    rows = random_table(rng)
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS conv", "2 AS stats", "3 AS head", "4 AS `a.b`")
    own = {c: [r[1:] for r in rows if r[0] == c] for c in {r[0] for r in rows}}
    got = {r.conv_id: tuple(r)[1:] for r in audit_conversations(table).collect()}
    assert got == {c: report(x)[0] for c, x in own.items()}
    left = {}
    for r in sorted(repair_turns(table).collect(), key=lambda r: (r.conv_id is None, r.conv_id, r.position)):
        left.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert left == {c: y for c, x in own.items() if (y := report(x)[1])}
    assert audit_conversations(table.limit(0)).count() == repair_turns(table.limit(0)).count() == 0


def test_query_against_plain_loops(spark, tmp_path):
    rows = random_table(random.Random(6)) + [(k, 0, "user", "Alone.") for k in range(100, 160)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    after = {r[0]: [] for r in rows}
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fault = zlib.crc32(key.encode()) % 20
        text = {1: "", 2: "".join(x for x in text if x not in ".!?")}.get(fault, text)
        after[c] += [(t, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    got = {r.conv_id: tuple(r)[1:] for r in op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {c: report(x)[0] for c, x in after.items()}
    assert any(not x for x in after.values())


def test_long_conversation_and_long_text(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(3000)] + [(2, 0, "user", "y" * 3_000_000)]
    got = {r.conv_id: r for r in audit_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert (got[1].cost, got[1].audit) == (0, "K" * 3000)
    assert (got[2].cost, got[2].audit, got[2].truncated) == (3, "D", 1)


@pytest.mark.parametrize("kind", ["string", "int"])
def test_identifiers_keep_their_type(spark, kind):
    table = spark.createDataFrame([(1, 0, "user", "A.")], "c long, n long, r string, t string").withColumn("c", F.col("c").cast(kind))
    out = audit_conversations(table, "c", "n", "r", "t")
    assert out.schema["c"].dataType.simpleString() == kind and out.first().audit == "KI"


def test_op12_query_equals_its_sql(spark):
    equals_sql(spark, "op12_conversation_repair", "/root/testdata/sf0.001")
