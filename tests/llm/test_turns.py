"""op13 against a uniform-cost search over edits, and its cases."""

import hashlib
import heapq
import random
import time

import pytest

from llm.llm_tools import duck, rows
from panelcast.llm import q_turns
from panelcast.llm.turns import _TO_SYMBOL, BlockTables, repair_report, repaired_turns

TURNS = "conv_id long, turn long, role string, text string"
SHOWN = "suao"


def search(codes):
    """(cost, audit): the least pair at the end; costs and audits only grow along a way."""
    after_insert = {0: 2, 1: 2, 2: 3, 3: 2}
    kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    seen, heap = set(), [(0, "", 0, 0)]
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(codes) and state in (0, 3):
            return cost, audit
        heapq.heappush(heap, (cost + 3, audit + "I", i, after_insert[state]))
        if i < len(codes):
            initial, fault = divmod(codes[i], 4)
            late = 3 * (fault == 3)
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if fault not in (1, 2):
                if (state, SHOWN[initial]) in kept:
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, kept[state, SHOWN[initial]]))
                heapq.heappush(heap, (cost + 3 + late, audit + "R", i + 1, after_insert[state]))


@pytest.mark.parametrize("block", [1, 2, 3, 4])
def test_tables_give_the_least_cost_and_audit(block):
    rng, tables = random.Random(block), BlockTables(block)
    assert len(tables.vectors) < 100
    for _ in range(2500):
        codes = bytes(rng.randrange(16) for _ in range(rng.randint(0, 12)))
        assert tables.solve(codes) == search(codes), codes


def test_a_very_long_conversation_in_seconds():
    rng, tables = random.Random(9), BlockTables()
    codes = bytes(rng.randrange(16) for _ in range(400_000))
    began = time.time()
    cost, audit = tables.solve(codes)
    assert time.time() - began < 10
    assert len(audit) - audit.count("I") == len(codes)
    late = [c % 4 == 3 for c in codes]
    edits = [e for e in audit if e != "I"]
    assert cost == 3 * audit.count("I") + sum({"D": 4, "K": 0, "R": 3}[e] + 3 * (x and e != "D") for e, x in zip(edits, late))


def brute(table):
    """Whole report of (conv, turn, role, text) rows in plain Python."""
    out = {}
    for conv in {r[0] for r in table}:
        mine = sorted(((t is not None, t or 0, " " if role is None else role, hashlib.sha256((" " if x is None else x).encode()).digest(), " " if x is None else x)
                       for c, t, role, x in table if c == conv), key=lambda r: r[:4])
        seen, codes = set(), []
        for _, _, role, _, text in mine:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not bare else 2 if (role, text) in seen else 0 if bare[-1] in ".!?" else 3
            seen.add((role, text))
            codes.append(4 * (SHOWN[:3].find(role[:1]) if role and role[0] in "sua" else 3) + fault)
        cost, audit = search(codes)
        state, lines, at = 0, [], 0
        for e in audit:
            role, text = (mine[at][2], mine[at][4]) if at < len(mine) else ("", "")
            forced = "assistant" if state == 2 else "user"
            if e == "K":
                lines.append(f"{role}:{text}")
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            elif e in "RI":
                lines.append(f"{forced}:{text if e == 'R' else ''}")
                state = 3 if state == 2 else 2
            at += e != "I"
        turns = [r[1] for r in mine if r[0]]
        shown = [SHOWN[c // 4] for c in codes]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(c % 4 == k for c in codes) for k in (1, 2, 3)),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(shown, shown[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_report_against_brute_force(spark):
    rng = random.Random(4)
    words = ["Yes.", "no", " ", "", "why?", "x" * 5000, "tail. \n", "a\n.\t", None, "é!"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "admin", "u:v"]
    table = [(rng.choice([None, 1, 2, 3, 2 ** 60, -4]), rng.choice([None, 0, 1, 2, 5, 9, -3]), rng.choice(roles), rng.choice(words)) for _ in range(160)]
    table += table[:20]
    frame = spark.createDataFrame(table, TURNS).selectExpr("*", "1 AS conv", "2 AS audit", "'k' AS kind", "0 AS copies", "'c' AS counts", "7 AS digest").repartition(7)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_report(frame).collect()}
    assert got == brute(table)


def test_repaired_turns_are_well_formed(spark):
    rng = random.Random(8)
    table = [(c, t, rng.choice(["system", "user", "assistant", "tool:x"]), rng.choice(["Ok.", "hm", "", f"t{t}: b."])) for c in range(12) for t in range(rng.randint(1, 9))]
    out = {}
    for r in repaired_turns(spark.createDataFrame(table, TURNS)).orderBy("conv_id", "turn").collect():
        out.setdefault(r["conv_id"], []).append(r)
    report = {r["conv_id"]: r for r in repair_report(spark.createDataFrame(table, TURNS)).collect()}
    for conv, r in report.items():
        lines = out.get(conv, [])
        assert [x["turn"] for x in lines] == list(range(len(lines)))
        assert hashlib.sha256("\n".join(f"{x['role']}:{x['text']}" for x in lines).encode()).hexdigest() == r["repaired_sha256"]
        initials = "".join(x["role"][0] for x in lines)
        initials = initials[1:] if initials[:1] == "s" else initials
        assert initials == "ua" * (len(initials) // 2)


def test_query_on_written_cases(spark, sf):
    table = [(1, t, r, "Same text.") for t in range(30) for r in ("user", "assistant")]
    table += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes."), (2, 1, "assistant", "Yes."), (None, None, None, None), (3, None, "user", "b"), (3, 4, "assistant", "c.")]
    table += [(c, 0, "user", "only one.") for c in range(10, 90)]  # some lose their only row
    folder = sf(conversations=spark.createDataFrame(table, TURNS))
    got = q_turns.op13(spark, folder).toPandas()
    assert len(got) == len({r[0] for r in table})
    assert (got["audit"] == "").any() and rows(got) == rows(duck(q_turns.SQL, folder))


def test_empty_table(spark, sf):
    assert q_turns.op13(spark, sf(conversations=spark.createDataFrame([], TURNS))).count() == 0
