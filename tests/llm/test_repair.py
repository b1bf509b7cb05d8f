import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanstar.llm import repair as rp
from gleanstar.llm.registry import table

NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
SPACE = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """(cost, audit) over (role, fault), by states of the grammar from the first turn on."""
    best = {0: (0, "")}

    def offer(to, cost, audit, into):
        if to not in into or (cost, audit) < into[to]:
            into[to] = (cost, audit)
            return True
        return False

    def insert(states):
        for _ in range(4):
            for q, (c, w) in list(states.items()):
                given = "a" if q == 2 else "u"
                offer(NEXT[q][given], c + 5, w + "I", states)
        return states

    best = insert(best)
    for role, found in turns:
        after = {}
        for q, (c, w) in best.items():
            offer(q, c + 2, w + "D", after)
            if found not in ("blank", "duplicate"):
                extra = 5 * (found == "truncated")
                if role[:1] in NEXT[q]:
                    offer(NEXT[q][role[:1]], c + extra, w + "K", after)
                given = "a" if q == 2 else "u"
                offer(NEXT[q][given], c + extra + 1, w + "R", after)
        best = insert(after)
    return min(best[q] for q in (0, 3) if q in best)


def brute(rows):
    """rows (conv, turn, role, text, times) to the operator's results."""
    convs = {}
    for conv, turn, role, text, times in rows:
        kept = convs.setdefault(conv, [])
        kept += [(turn, role if role is not None else " ", text if text is not None else " ")] * times
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in kept:
            tail = text.rstrip(SPACE)
            found = "blank" if not tail else "duplicate" if (role, text) in seen else "" if tail[-1] in ".!?" else "truncated"
            seen.add((role, text))
            turns.append((role, found))
            if found:
                count[found] += 1
        cost, audit = cheapest(turns)
        lines, state, at = [], 0, iter(kept)
        for edit in audit:
            _, role, text = next(at) if edit != "I" else (None, None, "")
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == 2 else "user"
            state = NEXT[state][role[:1]]
            lines.append(f"{role}:{text}")
        numbers = {t for t, _, _ in kept if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha))
    return sorted(map(repr, out))


letters = st.text("suaxSUAXD", max_size=40)


@settings(max_examples=400, deadline=None)
@given(letters, st.integers(1, 40))
def test_alignment_equals_states(codes, segment):
    old, rp.SEGMENT = rp.SEGMENT, segment
    try:
        cost, audits, state = rp.follow(codes, rp.afters(codes, rp._END), 0)
    finally:
        rp.SEGMENT = old
    turns = [("x" if c == "D" else c.lower(), "blank" if c == "D" else "truncated" if c.isupper() else "") for c in codes]
    assert state in (0, 3) and (cost, "".join(audits)) == cheapest(turns)


@settings(max_examples=100, deadline=None)
@given(st.text("suaxSUAD", max_size=8), st.integers(0, 3), st.lists(st.integers(0, 12), min_size=4, max_size=4))
def test_transitions_are_those_of_the_cheapest_paths(codes, state, after):
    step = rp.transitions(codes)
    after = tuple(a - min(after) for a in after)
    cost, audit, to = rp.aligned(codes, state, after)
    assert cost + after[to] == rp.before(step, after)[state]
    assert step[state][to] == cost
    assert sum(e != "I" for e in audit) == len(codes)


def odd_rows():
    rng = random.Random(9)
    texts = ["Yes.", "No", "  ", "", None, "Why?\n", "Well!", "ünü", "a" * 70 + ".", "a" * 70 + "b."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts), rng.choice([0, 1, 1, 1, 2])) for c in range(60) for _ in range(rng.randrange(1, 12))]
    rows += [(None, 1, "user", "Hi.", 1), (None, 2, "assistant", "Ho.", 1), (777, 1, "user", "x.", 0), (778, None, None, None, 1)]
    return rows


def test_repair_of_odd_rows(spark):
    rows = odd_rows()
    # one conversation with most of the rows, over many ranges, and one of equal rows only
    rng = random.Random(2)
    hot = [(1000, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Same.", f"t{t}.", f"t{t}", ""]), 1) for t in range(900)]
    rows += hot + [(1001, 5, "user", "Again.", 1)] * 700
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, times int").selectExpr("*", "times as conv", "text as part")
    got = rp.repair_conversations(df.repartition(7), times_col="times")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == brute(rows)
    assert rp.repair_conversations(df.limit(0), times_col="times").count() == 0
    # without counts, in few rows: every conversation at a border
    few = [r for r in rows if r[0] in (3, 4, None)]
    df = spark.createDataFrame(few, "conv_id long, turn long, role string, text string, times int").drop("times")
    assert sorted(map(repr, map(tuple, rp.repair_conversations(df).collect()))) == brute([(*r[:4], 1) for r in few])


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "conversations").collect()]
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        out.append((conv, turn, "user" if kind == 4 else role, text, {0: 0, 3: 2}.get(kind, 1)))
    from gleanstar.llm.q_repair import op12

    assert sorted(map(repr, map(tuple, op12(spark, "/root/testdata/sf0.01").collect()))) == brute(out)


@pytest.mark.parametrize("rows", [[(None, None, None, None)], [(1, None, "", ""), (1, 2, "user", ".")]])
def test_damage_of_nulls(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert rp.repair_conversations(rp.damage(df), times_col="times").count() == 1
