"""Structure repair of conversations through a suffix-shared automaton.

A conversation becomes a signature, one symbol a turn for its role and fault. Distinct signatures are dealt by range
over their reversed text, so those that end alike stand side by side: every shared ending is one node of the automaton,
built once from the end, and its cost-to-go and best edit for each state of the grammar are worked out there
and not again for each conversation (only the nodes at a border between two tasks are built in both). Nodes whose costs
differ by a constant are one class, so a node is a reference to shared values. A best audit suffix is a chain of edits
through the nodes: from one state an edit leads to one state only, so the least of equally cheap edits starts the least
of equally cheap suffixes.

Nulls in id, turn, role and text read as one space; rows of a null id are one conversation; a null turn sorts
first. Rows of equal turn stand by role, then text; rows alike are repeats of each other. A conversation may hold any
number of turns and texts of any length: turns are sorted by Spark and pass a task one by one, only its signature
and audit, one character a turn, are held whole. Those are one value of the result, as is its digest, which
must see the whole conversation in order: so one conversation is one task's work. An empty
table gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type
from pyspark.sql.window import Window

from peerline.llm.common import arrow_batches
from peerline.session import materialise

BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
LEGAL_PAIRS = ("su", "ua", "au")
LARGEST = 9_223_372_036_854_775_807

# Grammar (s?(ua)+)?: the state is what was seen last. An inserted or changed turn takes the role the state asks for.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ASKED = (USER, USER, ASSISTANT, USER)
KEEP_COST, CHANGE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
UNWANTED = "x"  # a blank or repeated turn; other symbols are the role's initial, upper case where the turn is truncated
# Edits of a plan: k keep, d delete, u and a change to user and assistant, U and A insert them.
PLAN, AUDIT = "kduaUA", "KDRRII"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copy): rows dropped, emptied, cut, repeated or given another role by the CRC of `conv_id:turn`."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(shown("text"), "".join(ENDS), "")).otherwise(shown("text"))
    return conversations.filter(kind != 0).select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def examined(turns: DataFrame) -> DataFrame:
    """Turns (conv, turn, role, text, copy) in order: `seq`, first fault, symbol, and what adds up to the gaps and illegal pairs.

    One shuffle by conversation serves both sorts: by text for the repeats, by turn for the order.
    """
    alike = Window.partitionBy("conv", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copy")
    in_order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "nth")
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(bare == "", "blank").when(F.col("nth") > 1, "duplicate").when(~F.right(bare, F.lit(1)).isin(*ENDS), "truncated")
    initial = F.left("role", F.lit(1))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    before = F.lag("turn").over(in_order)
    return (
        turns.repartition("conv")
        .withColumn("nth", F.row_number().over(alike))
        .select(
            "conv", "turn", "role", "text",
            F.row_number().over(in_order).alias("seq"),
            fault.alias("fault"),
            F.when(fault.isin("blank", "duplicate"), UNWANTED).when(fault.isNull(), known).otherwise(F.upper(known)).alias("symbol"),
            F.coalesce(~F.concat(F.lag(initial).over(in_order), initial).isin(*LEGAL_PAIRS), F.lit(False)).alias("illegal"),
            (F.col("turn").isNotNull() & (before.isNull() | (before != F.col("turn")))).alias("new_turn"),
        )
    )


def signatures(examined_turns: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, signature) of every conversation that has turns."""

    def count(what: Column) -> Column:
        return F.count_if(what).cast("long")

    spread = F.max("turn").cast("decimal(38,0)") - F.min("turn").cast("decimal(38,0)") + 1 - F.count_if("new_turn")
    in_order = F.sort_array(F.collect_list(F.struct("seq", "symbol")))
    return examined_turns.groupBy("conv").agg(
        F.when(F.max("turn").isNull(), 0).when(spread > LARGEST, LARGEST).otherwise(spread).cast("long").alias("gaps"),
        *(count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
        count(F.col("illegal")).alias("illegal"),
        F.array_join(F.transform(in_order, lambda turn: turn["symbol"]), "").alias("signature"),
    )


def _with_inserts(best: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The best (cost, edit) of each state once turns may be inserted first; of equally cheap edits the least."""
    while True:
        better = [min(best[q], (INSERT_COST + best[ASKED[q]][0], "I")) for q in range(4)]
        if better == best:
            return best
        best = better


NEVER = 1 << 40
LAST = _with_inserts([(0, ""), (NEVER, ""), (NEVER, ""), (0, "")])  # the node of the empty ending


@functools.cache
def _node(symbol: str, following: tuple[int, ...]) -> tuple[tuple[int, ...], int, str]:
    """A node from its symbol and the costs of the node that follows: (costs less the first, the first, edit of each state)."""
    role, late = symbol.lower(), TRUNCATED_COST if symbol.isupper() else 0
    best = []
    for q in range(4):
        ways = [(DELETE_COST + following[q], "D")]
        if symbol != UNWANTED:
            ways.append((CHANGE_COST + late + following[ASKED[q]], "R"))
            if (q, role) in KEEP:
                ways.append((KEEP_COST + late + following[KEEP[q, role]], "K"))
        best.append(min(ways))
    best = _with_inserts(best)
    first = best[0][0]
    return tuple(cost - first for cost, _ in best), first, "".join(edit for _, edit in best)


def _plan(symbols: str, edits: list[str]) -> str:
    """Edits of a signature, read from the node of the whole down to the empty ending; `edits[k]` is that of the last k symbols."""
    plan, q, left = [], START, len(symbols)
    while edit := (edits[left][q] if left else LAST[q][1]):
        if edit == "D":
            plan.append("d")
        elif edit == "K":
            q = KEEP[q, symbols[-left].lower()]
            plan.append("k")
        else:
            q = ASKED[q]
            role = "u" if q == USER else "a"
            plan.append(role.upper() if edit == "I" else role)
        left -= edit != "I"
    return "".join(plan)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(signature, cost, plan); signatures come in the order of their reversed text, so the nodes in use are one path."""
    costs, offsets, edits = [tuple(cost for cost, _ in LAST)], [0], [""]
    held = ""  # the reversed signature whose nodes are on the path
    for batch in batches:
        out = []
        for symbols in batch.column(0).to_pylist():
            ending = symbols[::-1]
            shared, most = 0, min(len(held), len(ending))
            while shared < most and held[shared] == ending[shared]:
                shared += 1
            del costs[shared + 1 :], offsets[shared + 1 :], edits[shared + 1 :]
            for symbol in ending[shared:]:
                cost, more, edit = _node(symbol, costs[-1])
                costs.append(cost)
                offsets.append(offsets[-1] + more)
                edits.append(edit)
            held = ending
            out.append((symbols, costs[-1][START] + offsets[-1], _plan(symbols, edits)))
        columns = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
            ["signature", "cost", "plan"],
        )


def plans(signed: DataFrame) -> DataFrame:
    """(signature, cost, plan): the cheapest edits of every distinct signature, of equally cheap audits the least."""
    parts = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ending = F.reverse("signature")
    dealt = signed.select("signature").distinct().repartitionByRange(parts, ending).sortWithinPartitions(ending)
    return dealt.mapInArrow(_solve, "signature string, cost long, plan string")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, place, edit, role, text) of every edit in order, and (conv, None, ...) after each conversation.

    A conversation comes as its plan, then its turns in order.
    """
    named = {"u": "user", "a": "assistant"}
    conv, plan, at, place, going = None, "", 0, 0, False

    def inserts():
        nonlocal at, place
        while at < len(plan) and plan[at] in "UA":
            yield conv, place, "I", named[plan[at].lower()], ""
            at, place = at + 1, place + 1

    for batch in batches:
        for key, its_plan, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "plan", "role", "text"))):
            if its_plan is not None:
                if going:
                    yield from inserts()
                    yield conv, None, None, None, None
                conv, plan, at, place, going = key, its_plan, 0, 0, True
                continue
            yield from inserts()
            edit = plan[at]
            at += 1
            if edit != "d":
                yield conv, place, "K" if edit == "k" else "R", role if edit == "k" else named[edit], text
                place += 1
    if going:
        yield from inserts()
        yield conv, None, None, None, None


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, SHA-256 of its `role:text` lines), fed line by line."""
    state, first = hashlib.sha256(), True
    for conv, place, _, role, text in rows:
        if place is None:
            yield conv, state.hexdigest()
            state, first = hashlib.sha256(), True
            continue
        state.update(f"{'' if first else '\n'}{role}:".encode())
        state.update(text.encode())
        first = False


def _in_order(planned: DataFrame, turns: DataFrame) -> DataFrame:
    """Each conversation's plan followed by its turns, whole conversations in one task each."""
    heads = planned.select("conv", "plan", F.lit(0).alias("seq"), *(F.lit(None).cast("string").alias(c) for c in ("role", "text")))
    rows = turns.select("conv", F.lit(None).cast("string").alias("plan"), "seq", "role", "text")
    return heads.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "seq")


def repaired_turns(planned: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): every turn of the repaired conversations, `place` from 0, with the edit that gave it."""
    schema = _arrow(planned, place=pa.int64(), edit=pa.string(), role=pa.string(), text=pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return arrow_batches((row for row in _edited(batches) if row[1] is not None), schema)

    return _in_order(planned, turns).mapInArrow(run, from_arrow_schema(schema))


def repaired_digests(planned: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of every conversation that has a plan."""
    schema = _arrow(planned, repaired_sha256=pa.string())
    return _in_order(planned, turns).mapInArrow(lambda batches: arrow_batches(_digests(_edited(batches)), schema), from_arrow_schema(schema))


def _arrow(planned: DataFrame, **columns: pa.DataType) -> pa.Schema:
    return pa.schema([("conv", to_arrow_type(planned.schema["conv"].dataType)), *columns.items()])


def repair(conversations: DataFrame) -> DataFrame:
    """Every conv_id with the faults of its rows after damage, the cheapest repair and the digest of the outcome.

    A conversation of which the damage leaves no row has zeros, an empty audit and the digest of the empty text.
    """
    turns = materialise(examined(damaged(conversations)), "turns")
    signed = materialise(signatures(turns), "signatures")
    solved = materialise(plans(signed), "plans")
    planned = signed.join(solved, "signature")
    every = conversations.select(F.col("conv_id").alias("conv_id")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    whole = materialise(
        every.join(planned, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
            F.col("conv_id").alias("conv"),
            *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts),
            F.coalesce("plan", F.lit("")).alias("plan"),
        ),
        "planned",
    )
    digests = repaired_digests(whole, turns).withColumnRenamed("conv", "conv_id")
    return digests.join(whole, F.col("conv_id").eqNullSafe(F.col("conv"))).select(
        "conv_id", *counts, F.translate("plan", PLAN, AUDIT).alias("audit"), "repaired_sha256"
    )
