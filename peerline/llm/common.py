"""Small pieces that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerline.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; no words for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other letter as it is."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def arrow_batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 1000, most_chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size; a single row may be longer."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most or size >= most_chars:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def window_hashes(ws: Column, size: int) -> Column:
    """A 64-bit hash, chained word by word, of every run of `size` words; of the whole if there are fewer, none of no words.

    `ws` must be a column or a bound value. Words are taken one by one: cutting a slice copies the whole array.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size(ws) - size, F.lit(0)))
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(size)]))
    return F.when(F.size(ws) > 0, hashed).otherwise(F.array().cast("array<bigint>"))


def run_lengths(ordered: Column) -> Column:
    """[(value, count)] of a sorted array."""

    def runs(s: Column) -> Column:
        starts = F.filter(
            F.transform(s, lambda v, k: F.when((k == 0) | (F.get(s, k - 1) != v), k)),
            lambda k: k.isNotNull(),
        )
        return let(
            starts,
            lambda b: F.transform(
                b,
                lambda k, j: F.struct(
                    F.get(s, k).alias("value"),
                    (F.coalesce(F.get(b, j + 1), F.size(s)) - k).alias("count"),
                ),
            ),
        )

    return let(ordered, runs)


def with_prefix_sums(df: DataFrame, groups: list[str], order: list[str], value: str, parts: int) -> DataFrame:
    """Add `before` and `group_total`: the sum of `value` ahead of each row in its group, and over the group.

    The rows are cut by range over (groups, order), so a group of any size spreads over
    many tasks; each task sums its own rows, and only one total per task and
    group is summed across tasks. Rows that agree in every column of `order` should be
    interchangeable. `df` is read twice and should be a written table.
    """
    ranged = df.repartitionByRange(parts, *groups, *order).withColumn("_part", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    local = Window.partitionBy("_part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*groups).orderBy("_part")
    totals = (
        ranged.groupBy("_part", *groups)
        .agg(F.sum(value).alias("_total"))
        .withColumn("_ahead", F.coalesce(F.sum("_total").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("group_total", F.sum("_total").over(Window.partitionBy(*groups)))
        .select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_of_{g}") for g in groups], "_ahead", "group_total")
    )
    summed = ranged.withColumn("_within", F.coalesce(F.sum(value).over(local), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return summed.join(totals, same).select(
        *df.columns, (F.col("_within") + F.col("_ahead")).alias("before"), "group_total"
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b): the smallest node that each one is linked to.

    Every round takes the smallest of a node's label, its neighbours' labels and the label of the node it points to,
    so long chains halve. Each round is written; labels only fall, so their sum tells when nothing moves any more.
    """
    both = materialise(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("component")),
        "labels",
    )
    total = F.sum(F.col("component").cast("decimal(38,0)"))
    before = labels.agg(total).first()[0]
    while True:
        offered = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("offer"))
        heads = labels.select(F.col("node").alias("head"), F.col("component").alias("further"))
        labels = materialise(
            labels.join(heads, F.col("component") == F.col("head"))
            .join(offered, F.col("node") == F.col("a"))
            .select("node", F.least("component", "further", "offer").alias("component")),
            "labels",
        )
        now = labels.agg(total).first()[0]
        if now == before:
            return labels
        before = now
