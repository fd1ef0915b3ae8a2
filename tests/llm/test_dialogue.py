"""Conversation repair against a brute-force version that carries whole audits."""

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from peerline.llm import dialogue, queries

FOLDER = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
GRAMMAR = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = "user" if kind == 4 else shown[2], "" if kind == 1 else shown[3]
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def cheapest(rows):
    """(cost, audit, repaired) over rows of (role, text, fault)."""
    steps = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}

    @functools.cache
    def best(i, state, inserts):
        ways = [] if i < len(rows) or state not in ("", "a") else [(0, "", ())]
        if inserts:
            for role in ("user", "assistant"):
                if (state, role[0]) in steps:
                    cost, audit, rest = best(i, role[0], inserts - 1)
                    ways.append((2 + cost, "I" + audit, ((role, ""), *rest)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, rest = best(i + 1, state, 3)
            ways.append((3 + cost, "D" + audit, rest))
            if fault not in ("blank", "duplicate"):
                for letter, price, name in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    if (state, name[:1]) in steps:
                        cost, audit, rest = best(i + 1, name[:1], 3)
                        ways.append((price + (fault == "truncated") + cost, letter + audit, ((name, text), *rest)))
        return min(ways, default=(1 << 40, "", ()))

    return best(0, "", 3)


def brute(table):
    groups = collections.defaultdict(list)
    for conv, turn, role, text in table:
        groups[conv].append((conv, turn, role, text))
    out = {}
    for conv, rows in groups.items():
        rows, seen, judged, counts = damage(rows), set(), [], collections.Counter()
        for _, role, text in rows:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, kept = cheapest(tuple(judged))
        assert GRAMMAR.fullmatch("".join(role[0] for role, _ in kept))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)
    return out


def got(df):
    rows = df.select(*COLUMNS).collect()
    found = {r[0]: tuple(r[1:]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_conversations_agree_with_brute_force(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = brute([tuple(r) for r in table.collect()])
    assert got(queries.op13_repair(spark, FOLDER)) == want
    assert {letter for row in want.values() for letter in row[6]} == set("DIKR")


def test_awkward_and_random_conversations(spark):
    some = random.Random(5)
    rows = [
        (1, 0, "user", None), (1, None, None, "no turn."), (2, 5, "system", "only."), (3, 1, "user", "long " * 600_000),
        (None, 1, "user", "null id."), (None, 2, "assistant", "null id"), (4, None, "user", "a."), (4, None, "tool", "b."),
        (5, -9_000_000_000_000_000_000, "user", "far."), (5, 9_000_000_000_000_000_000, "assistant", "apart."), (6, 1, "", "no role."),
    ]
    for conv in range(10, 400):
        for turn in range(some.randint(1, 9)):
            role = some.choice(["user", "assistant", "system", "tool", "User", ""])
            rows.append((conv, some.choice([turn, turn, None, 3]), role, some.choice(["Yes.", "No", " \n", "Same?", f"t{turn}!", "é… ok.\x0b"])))
    rows += [(500 + k, t, r, "x.") for k in range(60) for t, r in enumerate(["user", "assistant"])]
    df = spark.createDataFrame([(*r, "plan", 1) for r in rows], "conv_id long, turn long, role string, text string, plan string, seq int")
    want = brute(rows)
    want[5] = (9_223_372_036_854_775_807, *want[5][1:]) if want[5][0] > 2**63 - 1 else want[5]
    assert got(dialogue.repair(df)) == want
    assert dialogue.repair(df.limit(0)).count() == 0


def test_a_very_long_conversation(spark):
    df = spark.range(60_000).select(
        F.lit(7).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id", F.lit(".")).alias("text"),
    )
    (row,) = dialogue.repair(df).collect()
    assert row.cost > 0 and len(row.audit) >= 55_000


@pytest.mark.parametrize("symbols", ["".join(s) for s in itertools.product("xsuaoSU", repeat=3)])
def test_every_short_signature(symbols):
    names = {"s": "system", "u": "user", "a": "assistant", "o": "other", "x": "user"}
    rows = tuple((names[c.lower()], "t", "blank" if c == "x" else "truncated" if c.isupper() else None) for c in symbols)
    cost, audit, _ = cheapest(rows)
    node, more, edits = tuple(c for c, _ in dialogue.LAST), 0, [""]
    for symbol in reversed(symbols):
        node, first, edit = dialogue._node(symbol, node)
        more += first
        edits.append(edit)
    plan = dialogue._plan(symbols, edits)
    assert (node[0] + more, plan.translate(str.maketrans(dialogue.PLAN, dialogue.AUDIT))) == (cost, audit)


def test_repaired_turns_follow_the_grammar(spark):
    turns = dialogue.examined(dialogue.damaged(spark.read.parquet(f"{FOLDER}/conversations.parquet")))
    signed = dialogue.signatures(turns)
    planned = signed.join(dialogue.plans(signed), "signature")
    found = collections.defaultdict(list)
    for r in dialogue.repaired_turns(planned, turns).collect():
        found[r.conv].append((r.place, r.role[0], r.edit))
    assert found and all(GRAMMAR.fullmatch("".join(role for _, role, _ in sorted(rows))) for rows in found.values())
    assert all([p for p, *_ in sorted(rows)] == list(range(len(rows))) for rows in found.values())
