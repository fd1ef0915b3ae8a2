"""A Merkle manifest of a table: one tree of digests for each partition value, one root over all of them, a proof for each row.

Leaves stand in key order within their tree. At every level each node asks for its siblings by their computed
index (its run's start plus a shifted slot), an equijoin of the level with itself; the row in slot zero then
holds its whole run and emits the parent. Going down again every node adds its siblings to its parent's
proof, so what leaves of one run share is computed once. All work is keyed by (tree, index), which is unique: a tree
of any size spreads over all tasks.

Null fields are written `-`, others with their length, so no two rows that differ share a leaf. Null keys come first;
rows that repeat a key stand in the order of their leaves, rows alike in any order, each with its own
index. A null partition value makes a tree of its own, ahead of the others. An empty table gives no rows. A text
may have any length; it is read once and only its digest moves. Other columns of the table are
not read, so their names cannot clash.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerline.llm.common import LOWER, UPPER, with_prefix_sums
from peerline.session import materialise

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts), 256)


def row_digest(fields: Sequence[Column]) -> Column:
    """The leaf of a row: each field `-` if null, else its UTF-8 length, a colon and its text."""

    def framed(field: Column) -> Column:
        text = field.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return digest(*(framed(f) for f in fields))


def _tree(value: Column) -> Column:
    """A tree's name that is never null and sorts as its value does, bytewise, null first."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), value.cast("string")))


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Add `idx`, the place of each node in its tree, and `n`, how many there are."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    summed = with_prefix_sums(nodes.withColumn("one", F.lit(1)), ["tree"], order, "one", parts)
    return materialise(summed.withColumnsRenamed({"before": "idx", "group_total": "n"}).drop("one"), "numbered")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes of one level with the digests of their run to the left and to the right of them.

    Every node asks for the indices of its run's other slots; those beyond the end of the level are not asked for.
    """
    slot = F.col("idx") % FANOUT
    asked = nodes.select(
        "tree", "idx", "n", F.explode(F.transform(
            F.sequence(F.lit(1), F.lit(FANOUT - 1)), lambda shift: F.col("idx") - slot + (slot + shift) % FANOUT
        )).alias("sibling"),
    ).filter("sibling < n")
    others = nodes.select(F.col("tree").alias("its_tree"), F.col("idx").alias("at"), F.col("digest").alias("other"))
    met = asked.join(others, (F.col("tree") == F.col("its_tree")) & (F.col("sibling") == F.col("at")))
    runs = met.groupBy("tree", "idx").agg(F.sort_array(F.collect_list(F.struct("sibling", "other"))).alias("run"))

    def side(of) -> Column:
        picked = F.transform(F.filter("run", lambda s: of(s["sibling"])), lambda s: s["other"])
        return F.coalesce(F.array_join(picked, ""), F.lit(""))

    sides = runs.select("tree", "idx", side(lambda k: k < F.col("idx")).alias("left"), side(lambda k: k > F.col("idx")).alias("right"))
    return nodes.join(sides, ["tree", "idx"], "left").na.fill("", ["left", "right"])


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per level: nodes of trees that go on, with their siblings, and nodes that are the last of their tree."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, ended = [], []
    while most > 1:
        ended.append(nodes.filter("n = 1"))
        levels.append(materialise(_with_siblings(nodes.filter("n > 1")), "level"))
        nodes = levels[-1].filter(F.col("idx") % FANOUT == 0).select(
            "tree",
            F.expr(f"idx div {FANOUT}").alias("idx"),
            F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
            digest(F.col("digest"), F.col("right")).alias("digest"),
        )
        most = -(-most // FANOUT)
    return levels, [*ended, nodes]


def _descend(levels: list[DataFrame], ended: list[DataFrame], tops: DataFrame, payload: list[str]) -> DataFrame:
    """(tree, idx, digest, payload, what `tops` says of the tree, path): siblings from a lowest node's run up to the root's.

    `tops` is (tree, path, ...) with the path from a tree's last node on; `payload` are columns of the lowest level.
    """
    said = [c for c in tops.columns if c not in ("tree", "path")]
    paths = None
    for depth in range(len(levels), -1, -1):
        kept = ["tree", "idx", "digest", *(payload if depth == 0 else [])]
        here = ended[depth].select(*kept).join(tops, "tree")
        if paths is not None:
            above = paths.select(F.col("tree").alias("its_tree"), F.col("idx").alias("parent"), F.col("path").alias("further"), *said)
            of_parent = (F.col("tree") == F.col("its_tree")) & (F.expr(f"idx div {FANOUT}") == F.col("parent"))
            step = F.array(F.struct("left", "right")).cast(STEPS)
            level = levels[depth].join(above, of_parent)
            here = here.unionByName(level.select(*kept, *said, F.concat(step, "further").alias("path")))
        paths = here
    return paths


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    tree: str = "lang",
    fields: Sequence[str] = FIELDS,
    tampered: Mapping[str, Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """(key, leaf, subroot, root, path, proof_sha256, folded_root, verified) of every row.

    `path` holds, from the leaf's run up to the root's, the digests to the left and to the right of the row's own
    node. `tampered` gives other values for some fields in the rows `where` says: `folded_root` folds the
    leaf of those values along the untampered path, and `verified` tells whether that gives the root.
    """
    fields = list(fields)
    leaf = row_digest([F.col(f) for f in fields])
    forged = row_digest([(tampered or {}).get(f, F.col(f)) for f in fields])
    nodes = docs.select(
        F.col(key).alias("key"),
        _tree(F.col(tree)).alias("tree"),
        leaf.alias("digest"),
        F.when(where if where is not None else F.lit(False), forged).alias("forged"),
    )
    # The row's own number tells rows alike apart, so that a crowd of them is cut into ranges too.
    nodes = materialise(nodes, "leaves").withColumn("row", F.monotonically_increasing_id())
    levels, ended = _climb(_numbered(nodes, ["key", "digest", "row"]).drop("row"))

    subroots = functools.reduce(DataFrame.unionByName, (last.select("tree", "digest") for last in ended))
    named = materialise(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), "subroots")
    root_levels, root_ended = _climb(_numbered(named, ["of"]))
    root = root_ended[-1].select("tree", F.col("digest").alias("root"), F.array().cast(STEPS).alias("path"))
    over = _descend(root_levels, root_ended, root, ["of"])
    tops = materialise(over.select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "tops")

    proved = _descend(levels, ended, tops, ["key", "forged"])
    folded = F.aggregate(
        "path", F.coalesce("forged", "digest"), lambda node, step: digest(step["left"], node, step["right"])
    )
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    return proved.select(
        F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "path",
        F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_case_third(docs: DataFrame) -> DataFrame:
    """The manifest where a third of the rows, by the CRC of the decimal key, had A-Z of their text lower-cased."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(docs, tampered={"text": F.translate("text", UPPER, LOWER)}, where=hit)
