import functools
import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import connect, difference
from tidyforge.llm.conversations import Segments, end_costs, ordered_sha256, repair
from tidyforge.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, place int, edit string"
GOAL = re.compile(r"(s?(ua)+)?")
BLANK = re.compile("[^\x20\x09-\x0D]")


def fault_of(rows):
    """Faults of a conversation's (role, text) rows."""
    seen, out = set(), []
    for role, text in rows:
        signs = BLANK.findall(text)
        out.append("blank" if not signs else "duplicate" if (role, text) in seen
                   else "" if signs[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, audit, [(role, text)]) by looking at every edit of every row in every state."""
    told = fault_of(rows)
    leads = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    @functools.cache
    def best(i, state, inserted):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 3:
            for sign, name in names.items():
                if (state, sign) in leads:
                    c, a, r = best(i, leads[state, sign], inserted + 1)
                    ways.append((c + 5, "I" + a, ((name, ""), *r)))
        if i < len(rows):
            role, text = rows[i]
            c, a, r = best(i + 1, state, 0)
            ways.append((c + 2, "D" + a, r))
            if told[i] not in ("blank", "duplicate"):
                late = 5 * (told[i] == "truncated")
                for letter, own, price in [("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)]:
                    if (state, own[:1]) in leads:
                        c, a, r = best(i + 1, leads[state, own[:1]], 0)
                        ways.append((c + price + late, letter + a, ((own, text), *r)))
        return min(ways, default=(10**9, "", ()))
    return best(0, "", 0)


def plain(rows):
    """Everything about a conversation of (turn, role, text) rows in their order."""
    told = fault_of([r[1:] for r in rows])
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, left = plain_repair([r[1:] for r in rows])
    assert GOAL.fullmatch("".join(r[:1] for r, _ in left))
    return (gaps, told.count("blank"), told.count("duplicate"), told.count("truncated"), illegal,
            cost, audit, list(left))


def order(rows):
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2])))


def conversations(n, longest, seed):
    pick = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "one. ", "Why?\t", "x", "long " * 50 + "."]
    out = {}
    for conv in range(n):
        rows = []
        for turn in range(pick.randint(1, longest)):
            role = roles[turn % 2] if pick.random() < 0.6 else pick.choice(roles)
            text = f"Turn {turn}." if pick.random() < 0.6 else pick.choice(texts)
            rows.append((pick.choice([turn, turn, turn, turn, None, turn * 3, 2]), role, text))
        out[conv] = rows
    out[None] = [(0, "user", "Lost?"), (1, "assistant", "Found.")]
    out[-7] = [(5, "user", "Same.")] * 40 + [(6, "assistant", "Same.")] * 3
    out[-8] = [(None, None, None)] * 3
    return out


@pytest.mark.parametrize("segment, longest", [(4096, 9), (3, 9), (1, 6), (2, 70)])
def test_equals_plain_repair(spark, segment, longest):
    held = conversations(60, longest, seed=segment)
    rows = [(c, *r, 1, "z") for c, own in held.items() for r in own]
    random.Random(1).shuffle(rows)
    found, repaired = repair(spark.createDataFrame(rows, SCHEMA).repartition(4), segment=segment)
    got = {r["conv_id"]: tuple(r)[1:] for r in found.collect()}
    said = {}
    for r in sorted(repaired.collect(), key=lambda r: (r["place"], r["step"])):
        said.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert set(got) == set(held)
    for conv, own in held.items():
        assert (*got[conv], said.get(conv, [])) == plain(order(own)), (conv, order(own))


def test_a_conversation_of_many_segments(spark):
    pick = random.Random(9)
    own = [(t, pick.choice(["user", "assistant"]), pick.choice([f"t{t}.", f"t{t}", ""]))
           for t in range(700)]
    df = spark.createDataFrame([(1, *r, 1, "z") for r in own], SCHEMA).repartition(7)
    found, repaired = repair(df, segment=5)
    cost, audit, left = plain_long(own)
    assert found.select("cost", "audit").collect() == [(cost, audit)]
    got = sorted(repaired.collect(), key=lambda r: (r["place"], r["step"]))
    assert [(r["role"], r["text"]) for r in got] == list(left)


def plain_long(own):
    """As :func:`plain_repair`, from the last row to the first, without recursion."""
    told = fault_of([r[1:] for r in own])
    names = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    after = {"": (0, "", ()), "a": (0, "", ()), "u": (5, "I", (("assistant", ""),))}
    for i in reversed(range(len(own))):
        role, text = own[i][1:]
        now = {}
        for state in ("", "u", "a"):
            ways = [(after[state][0] + 2, "D" + after[state][1], after[state][2])]
            if told[i] not in ("blank", "duplicate"):
                late = 5 * (told[i] == "truncated")
                to = after[names[state][0]]
                ways.append((to[0] + late + 1, "R" + to[1], ((names[state], text), *to[2])))
                if role == names[state]:
                    ways.append((to[0] + late, "K" + to[1], ((role, text), *to[2])))
            now[state] = min(ways)
        for state in ("u", "a", ""):
            to = now[names[state][0]]
            now[state] = min(now[state], (to[0] + 5, "I" + to[1], ((names[state], ""), *to[2])))
        after = now
    return after[""]


def test_ranks_follow_the_audits():
    """Ranks of all nodes stand in the order of their least audits, read arc by arc."""
    pick = np.random.default_rng(4)
    lengths = [1, 7, 30, 2]
    initial, fault = pick.integers(0, 4, 40), pick.integers(0, 4, 40)
    segments = Segments(initial, fault, np.concatenate([[0], np.cumsum(lengths)]))
    paths = segments.rank(np.tile(end_costs(), (4, 1)), np.ones(4, bool))
    step = paths.pointers[0]

    def audit(node):
        out = ""
        while paths.letter[node]:
            out += "\0DIKR"[paths.letter[node]]
            node = step[node]
        return out
    audits = [audit(n) for n in range(len(step))]
    places = {a: i for i, a in enumerate(sorted(set(audits)))}
    assert [places[a] for a in audits] == paths.rank.tolist()


def test_empty_table_and_only_blank_rows(spark):
    found, repaired = repair(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 == repaired.count()
    found, repaired = repair(spark.createDataFrame([(1, 0, "user", "", 1, "z")], SCHEMA))
    assert found.collect() == [(1, 0, 1, 0, 0, 0, 2, "D")] and repaired.count() == 0


def test_hash_runs_in_order(spark):
    df = spark.createDataFrame([(i % 3 if i % 3 else None, i, f"l{i}") for i in range(50)],
                               "k long, i int, line string").repartition(6)
    got = dict(ordered_sha256(df, "k", ["i"], F.col("line")).collect())
    assert got == {k or None: hashlib.sha256("\n".join(
        f"l{i}" for i in range(50) if i % 3 == k).encode()).hexdigest() for k in range(3)}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_equals_its_sql(spark):
    name = "op11_conversation_repair"
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None
