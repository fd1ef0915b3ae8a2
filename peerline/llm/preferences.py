"""Preference pairs: a shared prompt once, and two completions with their loss masks."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerline.llm.common import with_prefix_sums
from peerline.session import materialise

ROWS_A_PART = 200_000


def _print(*cols: str) -> Column:
    """A 128-bit print of values, nulls told from empty texts; summed, it does not hang on order."""
    known = F.concat(*[F.coalesce(F.col(c).isNull().cast("string"), F.lit("")) for c in cols])
    return F.struct(
        F.xxhash64(known, *cols).alias("x"), F.xxhash64(F.lit(1), known, *cols).alias("y")
    )


def clean_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) without repeated rows and without rows that lack conv_id or turn."""
    whole = conversations.select("conv_id", "turn", "role", "text")
    return whole.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).distinct()


def turn_prints(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, print): equal prints, equal turns, whatever rows share the turn's number."""
    p = _print("role", "text")
    return turns.groupBy("conv_id", "turn").agg(
        F.struct(F.bit_xor(p["x"]).alias("x"), F.bit_xor(p["y"]).alias("y"), F.count("*").alias("n")).alias("print")
    )


def pair_by_opening(turns: DataFrame) -> DataFrame:
    """(conv_id, pair_id, side): conversations with the same first turn, two by two in the order of their ids.

    The smaller id of a pair is side 0, the chosen one, and names the pair. The last of an odd
    number stays alone with side 0. An opening shared by any number of conversations is ranked
    over many tasks.
    """
    opening = turn_prints(turns).groupBy("conv_id").agg(F.min_by("print", "turn").alias("opening"))
    flat = materialise(opening.select("conv_id", F.col("opening.x").alias("first_x"), F.col("opening.y").alias("first_y"), F.lit(1).alias("one")), "openings")
    parts = max(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + flat.count() // ROWS_A_PART)
    ranked = with_prefix_sums(flat, ["first_x", "first_y"], ["conv_id"], "one", parts)
    ranked = ranked.select("conv_id", "first_x", "first_y", F.expr("before div 2").alias("couple"), (F.col("before") % 2).cast("int").alias("side"))
    ranked = materialise(ranked, "ranked")
    named = ranked.filter("side = 0").select("first_x", "first_y", "couple", F.col("conv_id").alias("pair_id"))
    return ranked.join(named, ["first_x", "first_y", "couple"]).select("conv_id", "pair_id", "side")


def prefix_prints(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, depth, x, y): a 128-bit print of every turn prefix; equal prints, equal prefixes, turn numbers included.

    Prints of turns, 40 bytes each whatever the texts, are summed along a conversation.
    """
    along = Window.partitionBy("conv_id").orderBy("turn")
    of_turn = turn_prints(turns).select("conv_id", "turn", "print.*")
    return of_turn.select(
        "conv_id",
        "turn",
        F.row_number().over(along).cast("long").alias("depth"),
        F.bit_xor(F.xxhash64("turn", "x", "y", "n")).over(along).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "turn", "y", "x", "n")).over(along).alias("y"),
    )


def pair_at_longest_prefix(turns: DataFrame) -> DataFrame:
    """(conv_id, pair_id, side): conversations paired at the longest turn prefix they share with another one.

    Every conversation goes to its deepest prefix that a second one still has; those that meet there are paired two by two in
    the order of their ids, and an odd one looks again among those left. So a pair never shares less than either of
    the two shares with a conversation that stays alone. There are at most as many rounds as the longest shared prefix has turns. The
    smaller id of a pair is side 0, the chosen one, and names the pair; conversations that share no first turn stay alone
    with side 0. A prefix shared by any number of conversations is ranked over many tasks.
    """
    node = ["depth", "x", "y"]
    waiting = materialise(prefix_prints(turns), "prefixes")
    least = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done = []
    while True:
        shared = waiting.groupBy(*node).agg(F.count("*").alias("members")).filter("members > 1").drop("members")
        waiting = materialise(waiting.join(shared, node, "left_semi"), "shared") if done else waiting
        met = waiting.join(shared, node).groupBy("conv_id").agg(F.max(F.struct(*node)).alias("at"))
        met = materialise(met.select("conv_id", "at.*", F.lit(1).alias("one")), "met")
        n = met.count()
        if n == 0:
            break
        ranked = with_prefix_sums(met, node, ["conv_id"], "one", max(least, 1 + n // ROWS_A_PART))
        ranked = materialise(ranked.withColumn("couple", F.expr("before div 2")).withColumn("side", (F.col("before") % 2).cast("int")), "ranked")
        firsts = ranked.filter("side = 0").select(*node, "couple", F.col("conv_id").alias("pair_id"))
        whole = ranked.filter("before + 1 < group_total or side = 1")
        pairs = materialise(whole.join(firsts, [*node, "couple"]).select("conv_id", "pair_id", "side"), "paired")
        done.append(pairs)
        waiting = materialise(waiting.join(pairs.select("conv_id"), "conv_id", "left_anti"), "waiting")
    paired = functools.reduce(DataFrame.unionByName, done) if done else None
    every = turns.select("conv_id").distinct()
    if paired is None:
        return every.select("conv_id", F.col("conv_id").alias("pair_id"), F.lit(0).alias("side"))
    alone = every.join(paired, "conv_id", "left_anti").select("conv_id", F.col("conv_id").alias("pair_id"), F.lit(0).alias("side"))
    return paired.unionByName(alone)


def longest_prefix_preferences(conversations: DataFrame, train_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """The rows of `format_preferences` for every conversation of a table.

    Conversations that share turns are paired at their longest shared prefix. One that shares none is held against itself with
    another reply: the same turns up to its last one of a trained role, and in that one's place the last such turn of another conversation, which
    always differs. Both sides go through `format_preferences`, which finds the prompt by comparing them turn by turn. On
    rejected rows of the second kind `conv_id` is the conversation the reply was taken from. A conversation without such a turn, or
    where no other reply differs, is its chosen completion as a whole.

    Repeated rows, shared turn numbers, nulls and missing ids count as in `format_preferences`.
    """
    kind = conversations.schema["conv_id"].dataType
    own = materialise(clean_turns(conversations), "turns")
    paired = materialise(pair_at_longest_prefix(own), "pairs")
    sizes = paired.groupBy("pair_id").agg(F.count("*").alias("sides")).filter("sides = 1").select(F.col("pair_id").alias("conv_id"))

    last = own.groupBy("conv_id").agg(F.max(F.when(F.col("role").isin(*train_roles), F.col("turn"))).alias("last"))
    replies = own.join(materialise(last, "last"), "conv_id").filter(F.col("turn") == F.col("last"))
    replies = materialise(replies.select("conv_id", "turn", "role", "text"), "last-turns")
    prints = materialise(turn_prints(replies).select("conv_id", "turn", "print.*"), "prints")
    donors = prints.join(materialise(other_replies(prints), "others"), ["x", "y", "n"]).select("conv_id", F.col("turn").alias("fork"), "donor")
    donors = materialise(donors.join(sizes, "conv_id", "left_semi"), "donors")

    # Made conversations have names of their own, which tell whose place they take and whose reply they hold.
    name = F.concat(F.lit("="), F.col("conv_id").cast("string"))
    made = F.concat(F.lit("~"), F.col("conv_id").cast("string"), F.lit("\n"), F.col("donor").cast("string"))
    before = own.join(donors, "conv_id").filter(F.col("turn") < F.col("fork")).select(made.alias("conv_id"), "turn", "role", "text")
    given = replies.select(F.col("conv_id").alias("donor"), "role", "text").join(donors, "donor").select(
        made.alias("conv_id"), F.col("fork").alias("turn"), "role", "text"
    )
    turns = own.select(name.alias("conv_id"), "turn", "role", "text").unionByName(before).unionByName(given)
    pairs = paired.select(name.alias("conv_id"), F.concat(F.lit("="), F.col("pair_id").cast("string")).alias("pair_id"), "side").unionByName(
        donors.select(made.alias("conv_id"), name.alias("pair_id"), F.lit(1).alias("side"))
    )
    rows = format_preferences(turns, pairs, train_roles)
    source = F.when(F.col("conv_id").startswith("~"), F.substring_index("conv_id", "\n", -1)).otherwise(F.expr("substring(conv_id, 2)"))
    return rows.withColumns({"conv_id": source.cast(kind), "pair_id": F.expr("substring(pair_id, 2)").cast(kind)})


def _rendered() -> Column:
    return F.concat(
        F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("<|end|>\n")
    )


def other_replies(replies: DataFrame) -> DataFrame:
    """(x, y, n, donor): for every different reply (conv_id, x, y, n) the next one in the order of prints, as the smallest conversation that gives it.

    The last one gets the first, so every reply gets another one, unless there is only one. Ranked over many tasks.
    """
    one = replies.groupBy("x", "y", "n").agg(F.min("conv_id").alias("giver")).withColumn("one", F.lit(1)).withColumn("whole", F.lit(0))
    one = materialise(one, "replies")
    parts = max(int(replies.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + one.count() // ROWS_A_PART)
    ranked = materialise(with_prefix_sums(one, ["whole"], ["x", "y", "n"], "one", parts), "ranked")
    after = ranked.select(F.col("before").alias("place"), F.col("giver").alias("donor"))
    following = (F.col("before") + 1) % F.col("group_total")
    return ranked.filter("group_total > 1").join(after, following == F.col("place")).select("x", "y", "n", "donor")


def reply_preferences(turns: DataFrame, train_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """The rows of `format_preferences` for pairs made from each conversation by itself.

    The prompt is what comes before its last turn of a trained role, the chosen completion that turn and all after it, and the
    rejected completion the last such turn of another conversation in its place. The other turn always differs from the
    own one; on rejected rows `conv_id` is the conversation it was taken from and `turn` the place it takes. A
    conversation without such a turn, or where no other reply differs, stays alone: all of it is its chosen completion.

    Repeated rows, shared turn numbers, nulls and missing ids count as in `format_preferences`.
    """
    own = materialise(clean_turns(turns), "turns")
    mine = own.groupBy("conv_id").agg(F.max(F.when(F.col("role").isin(*train_roles), F.col("turn"))).alias("last"))
    mine = materialise(mine, "last")
    replies = own.join(mine.filter("last is not null"), "conv_id").filter(F.col("turn") == F.col("last"))
    replies = materialise(replies.select("conv_id", "turn", "role", "text"), "last-turns")
    prints = materialise(turn_prints(replies).select("conv_id", "print.*"), "prints")
    donors = prints.join(materialise(other_replies(prints), "others"), ["x", "y", "n"]).select("conv_id", "donor")
    before = own.join(mine, "conv_id").filter(F.col("turn") < F.col("last")).select("conv_id", "turn").distinct()
    counted = before.groupBy("conv_id").agg(F.count("*").alias("ahead"))
    heads = mine.join(donors, "conv_id", "left").join(counted, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"),
        F.when(F.col("donor").isNotNull(), F.col("last")).alias("fork"),
        "donor",
        F.when(F.col("donor").isNotNull(), F.coalesce("ahead", F.lit(0))).otherwise(0).cast("long").alias("prefix_turns"),
    )
    heads = materialise(heads, "heads")
    prompt = F.coalesce(F.col("turn") < F.col("fork"), F.lit(False))
    kept = own.join(heads, F.col("conv_id") == F.col("pair_id")).select(
        "pair_id", F.when(prompt, "prompt").otherwise("chosen").alias("part"), "conv_id", "turn", "role", "text", "prefix_turns",
        F.col("donor").isNotNull().alias("paired"),
    )
    given = replies.drop("turn").join(heads, F.col("conv_id") == F.col("donor")).select(
        "pair_id", F.lit("rejected").alias("part"), "conv_id", F.col("fork").alias("turn"), "role", "text", "prefix_turns", F.lit(True).alias("paired")
    )
    trained = (F.col("part") != "prompt") & F.coalesce(F.col("role").isin(*train_roles), F.lit(False))
    return kept.unionByName(given).select(
        "pair_id", "part", "conv_id", "turn", "role", _rendered().alias("rendered"),
        trained.cast("int").alias("loss_mask"), "prefix_turns", "paired",
    )


def format_preferences(turns: DataFrame, pairs: DataFrame, train_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per rendered turn: pair_id, part, conv_id, turn, role, rendered, loss_mask, prefix_turns, paired.

    `turns` is (conv_id, turn, role, text) and `pairs` is (conv_id, pair_id, side), side 0
    chosen and 1 rejected. The prompt is the longest run of turns from the start in which both agree in
    number, role and text; it is rendered once, with mask 0. What follows is the completion
    of either side (`part` is chosen or rejected), mask 1 for the roles to be trained and 0
    for the rest, so the two completions of a pair stand against the same prompt. A conversation without a
    partner has no prompt in common with anyone: all of it is its chosen completion.

    Turns are compared and rendered row by row, so a conversation of any length spreads over tasks; sorted by
    turn, the rows of a part join to its text. Repeated rows count once; several rows with one turn number are one turn;
    rows without conv_id or turn are in no conversation; null role or text renders as empty.
    """
    own = materialise(clean_turns(turns), "turns")
    sides = materialise(pairs.select("conv_id", "pair_id", "side"), "pairs")
    prints = turn_prints(own).join(sides, "conv_id")
    side = lambda n: F.max(F.when(F.col("side") == n, F.col("print")))
    compared = prints.groupBy("pair_id", "turn").agg(side(0).alias("a"), side(1).alias("b"))
    fork = compared.groupBy("pair_id").agg(
        F.min(F.when(~F.col("a").eqNullSafe(F.col("b")), F.col("turn"))).alias("fork_turn"),
        F.max(F.col("b").isNotNull()).alias("paired"),
        F.count("*").alias("whole"),
    )
    agreed = compared.join(fork, "pair_id").filter(F.col("fork_turn").isNull() | (F.col("turn") < F.col("fork_turn"))).groupBy("pair_id").agg(F.count("*").alias("prefix_turns"))
    heads = materialise(
        fork.join(agreed, "pair_id", "left").select("pair_id", "fork_turn", "paired", F.coalesce("prefix_turns", F.lit(0)).alias("prefix_turns")), "forks"
    )
    placed = own.join(sides, "conv_id").join(heads, "pair_id")
    prompt = F.col("fork_turn").isNull() | (F.col("turn") < F.col("fork_turn"))
    part = F.when(prompt, "prompt").when(F.col("side") == 0, "chosen").otherwise("rejected")
    role = F.coalesce("role", F.lit(""))
    return placed.filter(~prompt | (F.col("side") == 0)).select(
        "pair_id",
        part.alias("part"),
        "conv_id",
        "turn",
        "role",
        _rendered().alias("rendered"),
        (~prompt & role.isin(*train_roles)).cast("int").alias("loss_mask"),
        "prefix_turns",
        "paired",
    )
