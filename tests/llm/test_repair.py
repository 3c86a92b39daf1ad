"""Conversation repair against enumeration and a plain recursion."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from weirflow.llm.repair import AT_END, Trace, damage, repair_conversations, step

ROWS = "conv_id bigint, turn bigint, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = BLANK.findall(text)
        out.append("b" if not solid else "d" if (role, text) in seen else "" if solid[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def best_edit(rows, found):
    """(cost, audit, repaired rows) by recursion over rows and what the roles so far allow."""

    @lru_cache(None)
    def go(i, place):  # place: "", "s", "u", "a" is the last initial
        ways = []
        if i == len(rows):
            if place in ("", "a"):
                ways.append((0, "", ()))
        else:
            role, text = rows[i][2:]
            cost, audit, rest = go(i + 1, place)
            ways.append((cost + 3, "D" + audit, rest))
            if found[i] not in ("b", "d"):
                late = 1 if found[i] == "t" else 0
                allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[place]
                if role[:1] and role[:1] in allowed:
                    cost, audit, rest = go(i + 1, role[0])
                    ways.append((cost + late, "K" + audit, (f"{role}:{text}", *rest)))
                other = "assistant" if place == "u" else "user"
                cost, audit, rest = go(i + 1, other[0])
                ways.append((cost + 2 + late, "R" + audit, (f"{other}:{text}", *rest)))
        other = "assistant" if place == "u" else "user"
        if place in ("", "s", "u") or i < len(rows):
            deeper = inserts(i, other[0])
            ways += [(c + 2, "I" + a, (f"{other}:", *r)) for c, a, r in deeper]
        return min(ways)

    def inserts(i, place, left=2):
        """Ways after an insert: the next row's edits, or one more insert."""
        ways = []
        if i == len(rows):
            if place == "a":
                return [(0, "", ())]
        else:
            role, text = rows[i][2:]
            cost, audit, rest = go(i + 1, place)
            ways.append((cost + 3, "D" + audit, rest))
            if found[i] not in ("b", "d"):
                late = 1 if found[i] == "t" else 0
                if role[:1] == ("a" if place == "u" else "u"):
                    cost, audit, rest = go(i + 1, role[0])
                    ways.append((cost + late, "K" + audit, (f"{role}:{text}", *rest)))
                other = "assistant" if place == "u" else "user"
                cost, audit, rest = go(i + 1, other[0])
                ways.append((cost + 2 + late, "R" + audit, (f"{other}:{text}", *rest)))
        if left:
            other = "assistant" if place == "u" else "user"
            ways += [(c + 2, "I" + a, (f"{other}:", *r)) for c, a, r in inserts(i, other[0], left - 1)]
        return ways

    return go(0, "")


def expected(rows):
    """Rows as given, the whole table, to the result rows."""
    out = {}
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        found = faults(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(mine)]
        cost, audit, lines = best_edit(mine, found)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (
            gaps, found.count("b"), found.count("d"), found.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest
        )
    return out


def repaired(spark, rows, schema=ROWS, **holds):
    got = repair_conversations(damage(spark.createDataFrame(rows, schema)), **holds).collect()
    out = {r.conv_id: tuple(r)[1:] for r in got}
    assert len(out) == len(got)
    return out


def chatter(rng, conv, n):
    texts = ["Yes.", "No!", "Why?", "well", "hm,", " ", "", "é中 😀.", "a.\n", "x" * 300 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "u"]
    turns = [None if rng.random() < 0.03 else t + (rng.random() < 0.1) * 3 for t in range(n)]
    return [(conv, t, rng.choice(roles), None if rng.random() < 0.02 else rng.choice(texts)) for t in turns]


def test_steps_against_enumeration():
    """All edits of up to two rows, with up to three inserts in every gap."""
    fills = [x for n in range(4) for x in itertools.product("ua", repeat=n)]
    kinds = [(i, f) for i in "suat" for f in ("", "b", "t")]
    for rows in itertools.chain([()], itertools.product(kinds, repeat=1), itertools.product(kinds, repeat=2)):
        ways = []
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            for edits in itertools.product(("K", "Du", "Ru", "Ra"), repeat=len(rows)):
                cost, audit, initials = 2 * len(gaps[0]), "I" * len(gaps[0]), "".join(gaps[0])
                for (initial, fault), edit, gap in zip(rows, edits, gaps[1:], strict=True):
                    if edit == "Du":
                        cost += 3
                    elif fault == "b":
                        break
                    else:
                        cost += (edit != "K") * 2 + (fault == "t")
                        initials += initial if edit == "K" else edit[1]
                    audit += edit[0] + "I" * len(gap)
                    cost, initials = cost + 2 * len(gap), initials + "".join(gap)
                else:
                    if PATTERN.fullmatch(initials):
                        ways.append((cost, audit))
        costs, backs = AT_END, []
        for initial, fault in reversed(rows):
            costs, back = step(costs, initial, fault)
            backs.append(back)
        trace = Trace()
        for back, (initial, _) in zip(reversed(backs), rows, strict=True):
            trace.row(back, initial, "")
        assert (costs[0], trace.end()[0]) == min(ways), rows


def test_random_conversations(spark):
    rng = random.Random(11)
    rows = [r for c in range(60) for r in chatter(rng, c, rng.randint(1, 14))] + chatter(rng, None, 9)
    rng.shuffle(rows)
    want = expected(rows)
    assert repaired(spark, rows) == want
    # The same with almost everything spilled.
    assert repaired(spark, rows, hold_rows=2, hold_bytes=64) == want
    assert any("I" in w[6] for w in want.values()) and any("R" in w[6] for w in want.values())


def test_giant_conversation_is_spilled(spark):
    rng = random.Random(5)
    rows = chatter(rng, 7, 3000) + chatter(rng, 8, 5) + chatter(rng, None, 700)
    want = expected_long(rows)
    assert repaired(spark, rows, hold_rows=256) == want


def expected_long(rows):
    import sys

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(100_000)
    try:
        return expected(rows)
    finally:
        sys.setrecursionlimit(limit)


def test_odd_rows(spark):
    long = "word " * 50_000 + "end."
    gone = [t for t in range(400) if zlib.crc32(f"3:{t}".encode()) % 20 == 0][:2]
    rows = [
        (1, 0, "user", long), (1, 0, "user", long), (1, 1, "assistant", long),  # repeated rows, very long texts
        (2, None, None, None), (2, None, "user", "Hi."), (2, 5, None, "Ok."), (2, 9, "assistant", "Fine."),
        *[(3, t, "user", "Gone.") for t in gone],
        (4, -(2**62), "user", "Far."), (4, 2**62, "assistant", "Off."),
        (2**60 + 1, 0, "user", "Large id."), (2**60 + 2, 0, "user", "Large id."),
    ]
    want = expected(rows)
    assert want[3] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repaired(spark, rows) == want
    assert repair_conversations(damage(spark.createDataFrame([], ROWS))).count() == 0


def test_clashing_columns_and_text_ids(spark):
    rows = [("a", 0, "user", "Hi.", 1, True, "x"), (None, 0, "user", "Ho.", 2, False, "y")]
    got = repaired(spark, rows, "conv_id string, turn int, role string, text string, pos int, gone boolean, fault string")
    assert got == expected([r[:4] for r in rows])
    with pytest.raises(ValueError):
        repair_conversations(damage(spark.createDataFrame(rows[:1], "conv_id string, turn int, role string, text string, pos int, gone boolean, fault string")), 0)


def test_query(spark, sf):
    from weirflow.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_repair"](spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r)[1:] for r in got.collect()} == expected(rows)


def test_plan_has_one_exchange(spark, sf):
    from weirflow.llm.repair import _faults

    plan = _faults(damage(spark.read.parquet(f"{sf}/conversations.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
