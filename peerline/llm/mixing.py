"""Mixing sources to target weights: hash-random order, prefix sums, exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerline.llm.common import WORD, with_prefix_sums, words
from peerline.session import materialise

SEED = 17
REPEATS = 3  # no source gives more than this many times its own size
ROWS_A_PART = 200_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shares(sources: DataFrame, weight: Column, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) for a table (source, source_size, place).

    The total is shared by weight; whoever would get more than `repeats` times its own size
    is held there, and what is left is shared among the others until nobody is above. Each
    round moves two sums to the driver, whatever the number of sources.
    """
    table = materialise(sources.withColumn("_weight", weight.cast("double")).withColumn("_most", F.lit(repeats) * F.col("source_size")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("_weight") * F.lit(level) > F.col("_most")
        open_weight, held = table.agg(
            F.sum(F.when(~full, F.col("_weight"))), F.sum(F.when(full, F.col("_most")))
        ).first()
        if not open_weight:
            break
        above = (total - (held or 0)) / open_weight
        if above <= level:
            break
        level = above
    target = F.least(F.col("_weight") * F.lit(level), F.col("_most").cast("double"))
    return table.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weight: Column | None = None, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, passes, cut, taken): what the mix takes of each document.

    Documents stand in hash-random order within their source. A source goes round as
    often as its budget holds it, then up to the word at which the budget
    ends: `passes` whole copies and, from one document at most, the first `cut` words. `weight`
    may use `place`, the rank of the source by code point from 0, null last; by
    default the weights are 1, 2, 3, repeating.

    A null text has size 0, null sources form a source of their own, repeated rows are taken
    as documents of their own. Runs agree: the order hangs on seed and doc_id, ties on size and rows that
    tie in both are alike. No documents give no rows.
    """
    spark = docs.sparkSession
    sized = materialise(
        docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("_text")).withColumn(
            "_key", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("_text"))
        ),
        "sized",
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + sized.count() // ROWS_A_PART)
    found = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_prefix_sums(
        materialise(found.select("source", "source_size", F.col("source").isNull().alias("_last"), F.lit(1).alias("_one")), "found"),
        [], ["_last", "source"], "_one", parts,
    ).withColumnRenamed("before", "place")
    chosen = F.lit(1) + F.col("place") % 3 if weight is None else weight
    budget = materialise(shares(placed.select("source", "source_size", "place"), chosen, repeats), "budget")
    ordered = with_prefix_sums(sized, ["source"], ["_key", "doc_id", "size"], "size", parts)
    joined = ordered.join(budget, ordered["source"].eqNullSafe(budget["source"])).select(
        ordered["*"], budget["source_size"], budget["target"]
    )
    words_due = F.least(F.floor(F.col("target") + F.lit(0.5)), F.lit(repeats) * F.col("source_size"))
    passes = F.when(F.col("source_size") > 0, F.expr("_due div source_size")).otherwise(F.lit(0))
    return (
        joined.withColumn("_due", words_due.cast("long"))
        .withColumn("_rounds", passes)
        .withColumn("_rest", F.col("_due") - F.col("_rounds") * F.col("source_size") - F.col("before"))
        .withColumn("passes", F.col("_rounds") + F.when((F.col("_rest") >= F.col("size")) & (F.col("size") > 0), 1).otherwise(0))
        .withColumn("cut", F.when((F.col("_rest") > 0) & (F.col("_rest") < F.col("size")), F.col("_rest")).otherwise(F.lit(0)).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "passes", "cut",
                (F.col("passes") * F.col("size") + F.col("cut")).alias("taken"), F.col("_text").alias("text_hash"))
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents with their own columns: one row per whole pass, and the cut piece of a document at the border.

    A cut text holds its first `cut` words, one space between them.
    """
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.xxhash64("doc_id", "source", F.xxhash64("text")).alias("_id"),
    )
    plan = (
        mix(docs, **options)
        .groupBy(F.xxhash64("doc_id", "source", "text_hash").alias("_id"))
        .agg(F.sum("passes").alias("_passes"), F.count("*").alias("_alike"), F.max("cut").alias("_cut"))
    )
    # Rows alike in id, source and text stand for each other: their passes are added up and dealt out again.
    place = F.row_number().over(Window.partitionBy("_id").orderBy("_id"))
    dealt = (
        row.withColumn("_place", place)
        .join(plan, "_id")
        .withColumn("_passes", F.expr("_passes div _alike") + F.when(F.col("_place") <= F.col("_passes") % F.col("_alike"), 1).otherwise(0))
    )
    text = F.col("_row")["text"]
    cut = F.when((F.col("_cut") > 0) & (F.col("_place") == 1), F.array(F.array_join(F.slice(words(text), 1, F.col("_cut").cast("int")), " ")))
    pieces = F.concat(F.array_repeat(text, F.col("_passes").cast("int")), F.coalesce(cut, F.array().cast("array<string>")))
    one = dealt.select("_row", F.explode(pieces).alias("_text"))
    return one.select(*[F.col("_text").alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
