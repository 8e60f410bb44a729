"""Conversation repair against plain dynamic programming."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import found

from duelmetrics.llm.conversation_repair import (
    auction,
    audits,
    cheapest_edits,
    damaged,
    damaged_and_repaired,
    repair,
    repaired_rows,
)

SCHEMA = "conv_id bigint, turn bigint, role string, text string, content string, after int, known string, looks int"
ADDED = {0: [(2, "I"), (3, "II")], 1: [(2, "I"), (3, "II")], 2: [(3, "I")], 3: [(2, "I")]}
KEPT = {0: {0: 1, 1: 2}, 1: {1: 2}, 2: {2: 3}, 3: {1: 2}}


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "k", 2) for r in rows], SCHEMA)


def plain_edits(codes):
    """Least (cost, initials) of each state, row after row."""

    def with_added(best):
        every = list(best.items())
        every += [(q2, (c + 3 * len(i), a + i)) for q, (c, a) in best.items() for q2, i in ADDED[q]]
        return {q: min(x for p, x in every if p == q) for q in {q for q, _ in every}}

    best = with_added({0: (0, "")})
    for code in codes:
        options = []
        for q, (cost, audit) in best.items():
            options.append((q, (cost + 4, audit + "D")))
            if code != 8:
                more = 3 * (code >= 4)
                options.append((3 if q == 2 else 2, (cost + 3 + more, audit + "R")))
                if code % 4 in KEPT[q]:
                    options.append((KEPT[q][code % 4], (cost + more, audit + "K")))
        best = with_added({q: min(x for p, x in options if p == q) for q in {q for q, _ in options}})
    return min(best[q] for q in (0, 3) if q in best)


def plain_repair(rows):
    """The result columns of one conversation's rows (turn, role, text), given in order."""
    faults, seen, codes = [], set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        if not bare:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = None if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
        codes.append(8 if fault in ("blank", "duplicate") else ("sua".find(role[0]) if role else -1) % 4 + 4 * (fault is not None))
    cost, audit = plain_edits(codes)
    left, out = list(rows), []
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else left.pop(0)
        if edit in "IR":
            role = "assistant" if out and out[-1][0].startswith("u") else "user"
        if edit != "D":
            out.append((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }, out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 8), max_size=20), st.integers(1, 9))
def test_edits_equal_dynamic_programming(codes, block):
    assert cheapest_edits(bytes(codes), block) == plain_edits(codes)


def test_known_edits():
    s, u, a, other, gone = 0, 1, 2, 3, 8
    assert cheapest_edits(b"") == (0, "")
    assert cheapest_edits(bytes([s, u, a, u, a])) == (0, "KKKKK")
    assert cheapest_edits(bytes([u])) == (3, "KI")  # deleting costs 4
    assert cheapest_edits(bytes([u, u])) == (3, "KR")
    assert cheapest_edits(bytes([gone])) == (4, "D")
    assert cheapest_edits(bytes([other, a])) == (3, "RK")
    assert cheapest_edits(bytes([a, u])) == (6, "IKKI")  # ties: RR costs 6 too
    assert cheapest_edits(bytes([u + 4, a + 4])) == (6, "KK")


@settings(max_examples=100, deadline=None)
@given(st.integers(2, 12), st.randoms(use_true_random=False))
def test_auction_prices_are_distances(n, draw):
    arcs = [[("x", n - 1, draw.randint(1, 40))] + [("x", draw.randrange(n), draw.randint(1, 9)) for _ in range(3)] for _ in range(n)]
    arcs[n - 1] = []
    distance = [0 if i == n - 1 else 10**6 for i in range(n)]
    for _ in range(n):
        distance = [min([distance[i], *[c + distance[j] for _, j, c in arcs[i]]]) for i in range(n)]
    prices = [0] * n
    for origin in range(n - 1):
        assert auction(arcs, origin, n - 1, prices) == distance[origin]
        assert all(prices[i] <= c + prices[j] for i in range(n) for _, j, c in arcs[i])


def table_of(rows):
    by = {}
    for conv_id, turn, role, text in rows:
        by.setdefault(conv_id, []).append((turn, " " if role is None else role, " " if text is None else text))
    digest = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()
    for own in by.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
    return by


def awkward_rows():
    r = random.Random(9)
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(6)]
    rows += [(2, None, None, None), (2, 3, "", "no role."), (2, 3, "", "no role."), (2, 9, "user", " \n")]
    rows += [(3, 0, "assistant", "b" * 100_000), (3, 5, "tool", "日本語。"), (3, 7, "user", "Why?\r\n ")]
    rows += [(None, 0, "user", "x."), (None, None, "assistant", "y!")]
    rows += [(4, 1, "user", "same.")] * 5 + [(4, 2, "assistant", "same.")] * 3
    for conv in range(5, 40):
        for k in range(r.randrange(12)):
            text = r.choice(["ok.", "", "cut", "so?", "\t", "cut", "one.", "two!"]) if r.random() < 0.7 else None
            rows.append((conv, r.choice([k, k + 3, None]), r.choice(["user", "assistant", "system", "tool", None]), text))
    return rows


def test_repair_equals_a_plain_version(spark):
    rows = awkward_rows()
    df = conversations(spark, rows).repartition(6)
    got = {r.pop("conv_id"): r for r in found(repair(df))}
    by = table_of(rows)
    assert got == {conv_id: plain_repair(own)[0] for conv_id, own in by.items()}
    out = {}
    for r in sorted(found(repaired_rows(df)), key=lambda r: r["place"]):
        out.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert out == {conv_id: fixed for conv_id, own in by.items() if (fixed := plain_repair(own)[1])}


def plain_damage(rows):
    for conv_id, turn, role, text in rows:
        shown = [" " if x is None else x for x in (conv_id, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        yield from [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def test_damage_and_lost_conversations(spark):
    rows = awkward_rows() + [(c, c % 4, "user", f"alone {c}.") for c in range(100, 200)]
    df = conversations(spark, rows)
    hurt = list(plain_damage(rows))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, damaged(df).collect()), key=key) == sorted(hurt, key=key)
    by = table_of(hurt)
    lost = {r[0] for r in rows} - set(by)
    assert lost
    got = {r.pop("conv_id"): r for r in found(damaged_and_repaired(df))}
    assert got == {c: plain_repair(by.get(c, []))[0] for c in {r[0] for r in rows}}


def test_a_long_conversation_and_no_rows(spark):
    rows = [(1, k, ("user", "user", "assistant", "system")[k * k % 4], f"{k}" + "." * (k % 3)) for k in range(20_000)]
    got = found(repair(conversations(spark, rows)))
    assert got == [{"conv_id": 1, **plain_repair([r[1:] for r in rows])[0]}]
    empty = conversations(spark, rows[:1]).filter("false")
    assert found(repair(empty)) == [] and found(damaged_and_repaired(empty)) == [] and found(repaired_rows(empty)) == []


def test_texts_are_not_shuffled_for_the_audit(spark, tmp_path):
    conversations(spark, awkward_rows()).write.parquet(f"{tmp_path}/c")
    plan = audits(spark.read.parquet(f"{tmp_path}/c"))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning(conv_id") :]
    assert "text" not in plan[: plan.index("Exchange")] and "text" in below


@pytest.mark.parametrize("n", [1, 7, 8, 9, 16, 17])
def test_block_borders(n):
    for seed in range(20):
        codes = bytes(random.Random(seed * 31 + n).choices(range(9), k=n))
        assert cheapest_edits(codes) == plain_edits(codes)
