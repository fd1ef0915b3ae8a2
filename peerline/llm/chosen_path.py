"""Near-duplicate join by chosen paths over word shingles.

Two texts are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or more. Every set is
sampled down to the shingles whose hash lies under a bound that shrinks with the set, so two sets sample shared
shingles together. Each of `runs` runs hands a set on along sampled shingles; a path that too many sets
share is split again along further shingles, and small buckets are compared directly. A linked pair shares about
one path a run on average, so the runs multiply until the target recall.

Near copies of one text share most shingles and no split parts them. Such a crowd is measured against a pivot instead:
Jaccard distance is a metric, so members whose distances to the pivot add up to 0.2 at most are linked, and members whose
distances differ by more are not, without a look. Ordered by that distance a crowd falls into blocks; links between
blocks of the first kind are counted, blocks of the second kind never meet, and only the others are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerline.llm.bwt_repeats import BASE, Rolling, binary, mixed, slices
from peerline.llm.common import connected_components, with_prefix_sums
from peerline.operators.rows import fresh_name
from peerline.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.99
SKETCH = 48  # sampled shingles kept of a set, on average, to split buckets and to judge pairs
SMALL = 64  # sets in a bucket that are compared directly
DEPTH = 4  # splits after which a bucket counts as a crowd, whatever it looks like
SPLIT = 1.5  # shared shingles that hand a pair on, on average, at each split
LIKELY = 0.55  # sampled similarity from which a pair is read in full
BLOCK_SETS = 2048  # sets in a block of a crowd at most
BLOCK_SHINGLES = 1 << 20  # their shingles, but for the last set's
PAIRS = 4096  # pairs read in one group
DENSE = 0.25  # sampled similarity to one member, on average, from which a bucket counts as a crowd: above it splits hardly part it
COLUMNS = 4096  # shingles in one matrix product
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def runs_for(recall: float) -> int:
    """Runs after which a pair that shares one path a run on average is found with this probability.

    A pair of a large bucket survives any number of further splits of SPLIT shared shingles each with the
    probability that a branching process never dies out.
    """
    survive = 1.0
    for _ in range(200):
        survive = 1 - math.exp(-SPLIT * survive)
    return max(1, math.ceil(-math.log(1 - recall) / survive))


def _under(value: Column, bound: Column) -> Column:
    """Whether a hash, read as a number from 0 to 1, lies under the bound."""
    return F.shiftrightunsigned(value, 1).cast("double") < F.lit(2.0**63) * bound


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, sorted: runs of `size` words, the whole text if it has fewer, none without words."""
    data, sizes = binary(texts)
    ends = np.cumsum(sizes)
    solid = ~SPACE[data]
    border = np.zeros(len(data) + 1, bool)
    border[ends] = border[0] = True
    starts = np.flatnonzero(solid & np.concatenate([[True], ~solid[:-1]])[: len(solid)] | solid & border[:-1])
    stops = np.flatnonzero(solid & (np.concatenate([~solid[1:], [True]])[: len(solid)] | border[1:])) + 1
    hashes = Rolling(data).of(starts, stops)
    counts = np.bincount(np.searchsorted(ends, starts, side="right"), minlength=len(sizes))
    runs = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size if len(runs) else 0):
        runs = runs * BASE + hashes[k : k + len(runs)]
    runs = mixed(runs)
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(runs[at : at + n - size + 1]))
        elif n:
            short = np.uint64(n)
            for h in hashes[at : at + n]:
                short = np.uint64((int(short) * int(BASE) + int(h)) % 2**64)
            out.append(mixed(np.array([short])))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def _names(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    first, second = mixed(s).sum(dtype=np.uint64), mixed(s ^ BASE).sum(dtype=np.uint64)
    return int(first.astype(np.int64)), int(second.astype(np.int64))


def sampled(docs: DataFrame, sketch: int = SKETCH) -> DataFrame:
    """(doc_id, row, x, y, n, near): a hash that names the row, two that name the set, its size, and its sampled shingles. Texts without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                sets = shingle_sets(batch.column(1).slice(a, b - a))
                held = [i for i, s in enumerate(sets) if len(s)]
                named = [_names(sets[i]) for i in held]
                near = [s[(s >> np.uint64(1)) < np.uint64(min(1.0, sketch / (SIMILARITY * len(s))) * 2.0**63)] for s in (sets[i] for i in held)]
                flat = np.concatenate(near) if near else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(held, pa.int64())),
                        batch.column(2).slice(a, b - a).take(pa.array(held, pa.int64())),
                        pa.array([x for x, _ in named], pa.int64()),
                        pa.array([y for _, y in named], pa.int64()),
                        pa.array([len(sets[i]) for i in held], pa.int32()),
                        pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(s) for s in near])]).astype(np.int32), flat.view(np.int64)),
                    ],
                    names=["doc_id", "row", "x", "y", "n", "near"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", _row()).mapInArrow(run, f"doc_id {kind}, row long, x long, y long, n int, near array<bigint>")


def _row() -> Column:
    """Names a row, with or without a doc_id: rows of one name have one text."""
    return F.xxhash64("doc_id", "text").alias("row")


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set, copies, s) of (text, set, copies, x) where the text still has the set it was asked for."""
    for batch in batches:
        for a, b in slices(batch.column(0)):
            sets = shingle_sets(batch.column(0).slice(a, b - a))
            want = batch.column(3).slice(a, b - a).to_pylist()
            held = [i for i, s in enumerate(sets) if len(s) and _names(s)[0] == want[i]]
            flat = np.concatenate([sets[i] for i in held]) if held else np.zeros(0, np.uint64)
            taken = pa.array(held, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).slice(a, b - a).take(taken),
                    batch.column(2).slice(a, b - a).take(taken),
                    pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(sets[i]) for i in held])]).astype(np.int32), flat.view(np.int64)),
                ],
                names=["set", "copies", "s"],
            )


def _estimate(a: np.ndarray, b: np.ndarray, bound: int) -> tuple[int, int]:
    a, b = a[a < bound], b[b < bound]
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared, len(a) + len(b) - shared


def _as_fraction(tokens: np.ndarray) -> np.ndarray:
    return (np.asarray(tokens, np.int64).view(np.uint64) >> np.uint64(1)).astype(np.int64)


def _likely_pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one slot's small buckets whose sampled shingles make similarity plausible, each once."""
    rows = rows.sort_values(["path", "set"], kind="stable")
    paths, sets, sizes = rows["path"].to_numpy(), rows["set"].to_numpy(), rows["n"].to_numpy(np.int64)
    near = [_as_fraction(x) for x in rows["near"]]
    cuts = np.flatnonzero(np.diff(paths)) + 1
    found: set[tuple[int, int]] = set()
    tried: set[tuple[int, int]] = set()
    for start, stop in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(paths)]])):
        for i in range(start, stop):
            for j in range(i + 1, stop):
                small, large = sorted((int(sizes[i]), int(sizes[j])))
                pair = (int(sets[i]), int(sets[j]))
                if small < SIMILARITY * large or pair in tried:
                    continue
                tried.add(pair)
                # Under the larger set's bound both are sampled alike.
                bound = int(min(1.0, SKETCH / (SIMILARITY * large)) * 2.0**63)
                shared, union = _estimate(near[i], near[j], bound)
                if shared >= LIKELY * union - 1:
                    found.add(pair)
    return pd.DataFrame(sorted(found), columns=["a", "b"])


def _read_sets(rows: pd.DataFrame) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    return rows["set"].to_numpy(np.int64), [np.asarray(s, np.int64) for s in rows["s"]], rows["copies"].to_numpy(np.int64)


def _confirm(key: tuple, sets: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """(a, b) of the pairs whose full sets are similar enough."""
    ids, full, _ = _read_sets(sets)
    at = dict(zip(ids.tolist(), full))
    out = []
    for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist()):
        x, y = at[a], at[b]
        shared = len(np.intersect1d(x, y, assume_unique=True))
        if shared >= SIMILARITY * (len(x) + len(y) - shared) - 1e-9:
            out.append((a, b))
    return pd.DataFrame(out, columns=["a", "b"])


def _block_pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of a crowd, or within one: how many each set has, and a forest of them.

    Rows: (a, b, links); b is null where the row counts links of a, links is 0 where it is an edge of the forest.
    """
    first, second = int(key[1]), int(key[2])
    ids, full, copies = _read_sets(rows)
    block = rows["block"].to_numpy(np.int64)
    sizes = np.array([len(f) for f in full])
    vocabulary, codes, times = np.unique(np.concatenate(full), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(full)), sizes)
    # Shingles of one set alone are shared by no pair.
    common = np.cumsum(times > 1) - 1
    owner, codes = owner[times[codes] > 1], common[codes[times[codes] > 1]]
    left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    shared = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(codes.max(initial=-1)) + 1, COLUMNS):
        here = (codes >= start) & (codes < start + COLUMNS)
        dense = np.zeros((len(full), COLUMNS), np.float32)
        dense[owner[here], codes[here] - start] = 1
        shared += dense[left] @ dense[right].T
    linked = shared >= SIMILARITY * (sizes[left][:, None] + sizes[right][None, :] - shared) - 1e-6
    links = np.zeros(len(full), np.int64)
    if first == second:
        np.fill_diagonal(linked, False)
    else:
        links[right] = linked.T @ copies[left]
    links[left] += linked @ copies[right]
    near = np.zeros((len(full), len(full)), bool)
    near[np.ix_(left, right)] = linked
    near |= near.T
    out = [(int(ids[i]), None, int(links[i])) for i in np.flatnonzero(links)]
    reached = np.zeros(len(ids), bool)
    for root in range(len(ids)):
        if reached[root]:
            continue
        reached[root] = True
        edge = [root]
        while edge:
            at = edge.pop()
            new = np.flatnonzero(near[at] & ~reached)
            reached[new] = True
            out += [(int(ids[at]), int(ids[j]), 0) for j in new]
            edge += new.tolist()
    return pd.DataFrame({"a": [r[0] for r in out], "b": pd.array([r[1] for r in out], "Int64"), "links": [r[2] for r in out]})


def _crowds(in_large: DataFrame) -> DataFrame:
    """(set, crowd, held): buckets that share members are one crowd; `held` counts the buckets a set is in."""
    heads = in_large.groupBy("path").agg(F.min("set").alias("head"))
    held = in_large.groupBy("set").agg(F.count("*").alias("held"))
    edges = in_large.join(heads, "path").select(F.col("set").alias("a"), F.col("head").alias("b"))
    labels = connected_components(edges)
    return labels.select(F.col("node").alias("set"), F.col("component").alias("crowd")).join(held, "set")


def _crowd_links(crowds: DataFrame, full: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) that connect what is linked within each crowd, and (set, links) of its members.

    Every member meets its crowd's pivot once, the member that most buckets hold. A block of members meets another
    only where the distances to the pivot leave open whether they are linked.
    """
    parts = int(full.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    far = 1 - SIMILARITY
    pivots = crowds.groupBy("crowd").agg(F.max_by("set", F.struct("held", -F.col("set"))).alias("pivot"))
    pivots = materialise(pivots.join(full.select(F.col("set").alias("pivot"), F.col("s").alias("pivot_s")), "pivot"), "pivots")
    shared = F.size(F.array_intersect("s", "pivot_s"))
    measured = (
        crowds.select("set", "crowd").join(full, "set").join(pivots, "crowd").select(
            "crowd", "set", "copies", "pivot", F.size("s").alias("n"),
            (1 - shared / (F.size("s") + F.size("pivot_s") - shared)).alias("distance"),
        )
    )
    weight = F.greatest(F.col("n"), F.lit(BLOCK_SHINGLES // BLOCK_SETS))
    measured = materialise(measured.withColumn("weight", weight), "measured")
    placed = with_prefix_sums(measured, ["crowd"], ["distance", "set"], "weight", parts).select(
        "crowd", "set", "copies", "pivot", "distance", F.expr(f"before div {BLOCK_SHINGLES}").alias("block")
    )
    placed = materialise(placed, "placed")
    spans = materialise(
        placed.groupBy("crowd", "block").agg(
            F.min("distance").alias("low"), F.max("distance").alias("high"), F.sum("copies").alias("all_copies")
        ),
        "spans",
    )
    others = spans.select("crowd", *(F.col(c).alias(f"{c}2") for c in ("block", "low", "high", "all_copies")))
    meets = spans.join(others, "crowd").filter((F.col("block") <= F.col("block2")) & (F.col("low2") - F.col("high") <= far + 1e-9))
    meets = materialise(meets.withColumn("sure", F.col("high") + F.col("high2") <= far - 1e-9), "meets")

    sure, own = meets.filter("sure"), F.col("block") == F.col("block2")
    gained = sure.select("crowd", "block", F.col("all_copies2").alias("links"), own.alias("own")).unionByName(
        sure.filter(~own).select("crowd", F.col("block2").alias("block"), F.col("all_copies").alias("links"), F.lit(False).alias("own"))
    )
    gained = gained.groupBy("crowd", "block").agg(F.sum("links").alias("links"), F.max("own").alias("own"))
    counted = placed.join(gained, ["crowd", "block"]).select(
        "set", (F.col("links") - F.when(F.col("own"), F.col("copies")).otherwise(0)).alias("links")
    )
    # Whatever is linked for sure is linked to the pivot.
    to_pivot = placed.filter((F.col("distance") <= far + 1e-9) & (F.col("set") != F.col("pivot")))

    open_ = meets.filter(~F.col("sure")).select("crowd", F.col("block").alias("b1"), F.col("block2").alias("b2"))
    sides = open_.select("crowd", F.col("b1").alias("block"), "b1", "b2").unionByName(
        open_.filter("b1 <> b2").select("crowd", F.col("b2").alias("block"), "b1", "b2")
    )
    compared = materialise(
        placed.select("crowd", "block", "set").join(sides, ["crowd", "block"]).join(full, "set").groupBy("crowd", "b1", "b2").applyInPandas(
            _block_pairs, "a long, b long, links long"
        ),
        "crowd-links",
    )
    edges = to_pivot.select(F.col("set").alias("a"), F.col("pivot").alias("b")).unionByName(
        compared.filter("b is not null").select("a", "b")
    )
    return edges, counted.unionByName(compared.filter("b is null").select(F.col("a").alias("set"), "links"))


def near_duplicates(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies) for every row of `docs`.

    class_id is the smallest doc_id reached over links; n_links counts the other rows whose shingle
    set is similar enough, rows with the same set included; n_copies those with the same set alone. Rows with equal
    sets are joined first and stand for one set. A text of one to four words is one shingle; null, empty and blank texts have none and link
    to nothing. Rows without a doc_id link like all others, but name no class, and their own stays null.

    Whatever the size of a bucket, all of it is used: buckets over `SMALL` sets are split again until they are small
    or made of near copies of each other. Those that share members form a crowd, which is measured against a pivot: a
    set is sent to its pivot and to the blocks for which that distance leaves the answer open, and links are
    counted in place instead of being sent as pairs.

    Only doc_id and text are read; other columns may have any name.
    """
    spark = docs.sparkSession
    runs = runs_for(recall)
    marked = materialise(sampled(docs), "sampled")
    # One row a set: an id, its copies, the smallest document, and a row whose text is read for it.
    sets = materialise(
        marked.groupBy("x", "y").agg(
            F.min("doc_id").alias("doc"), F.min("row").alias("row"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("near").alias("near")
        ).withColumn("set", F.monotonically_increasing_id()),
        "sets",
    )
    n = F.col("n")
    chosen = F.filter("near", lambda t: _under(t, F.lit(float(runs)) / (SIMILARITY * n)))
    paths = materialise(sets.select("set", "n", F.explode(chosen).alias("path")), "paths")
    small, large = [], []
    for depth in range(DEPTH + 1):
        sized = paths.groupBy("path").agg(F.count("*").alias("members")).filter("members > 1")
        known = materialise(sized, "buckets")
        joined = paths.join(known, "path")
        small.append(joined.filter(F.col("members") <= SMALL).select("set", "path"))
        crowded = joined.filter(F.col("members") > SMALL).select("set", "n", "path", "members")
        if depth == DEPTH:
            large.append(crowded.select("set", "path"))
            break
        if known.filter(F.col("members") > SMALL).isEmpty():
            break
        crowded = materialise(crowded.join(sets.select("set", "near"), "set"), "crowded")
        # A bucket whose members are mostly like one of them would not get smaller: it is compared as it is.
        pivot = crowded.groupBy("path").agg(F.min_by("near", "set").alias("pivot"))
        same = F.size(F.array_intersect("near", "pivot"))
        like = same / (F.size("near") + F.size("pivot") - same)
        dense = materialise(
            crowded.join(pivot, "path").groupBy("path").agg(F.avg(like).alias("like")).select("path", (F.col("like") >= DENSE).alias("dense")), "dense"
        )
        crowded = crowded.join(dense, "path")
        large.append(crowded.filter("dense").select("set", "path"))
        # Along the other paths, further shingles of the sample are drawn by a hash of path and shingle.
        drawn = crowded.filter("not dense").withColumn(
            "next",
            F.expr(
                f"filter(transform(near, t -> xxhash64(path, t)), h -> shiftrightunsigned(h, 1) < "
                f"{2.0**63} * {SPLIT} / ({SIMILARITY} * greatest(size(near), 1)))"
            ),
        )
        paths = materialise(drawn.select("set", "n", F.explode("next").alias("path")), "paths")

    in_small = small[0]
    for more in small[1:]:
        in_small = in_small.unionByName(more)
    # Buckets with the same members say the same.
    member_lists = in_small.groupBy("path").agg(F.sort_array(F.collect_set("set")).alias("members"))
    small_buckets = member_lists.groupBy("members").agg(F.min("path").alias("path"))
    in_small = materialise(
        small_buckets.filter(F.size("members") > 1).select("path", F.explode("members").alias("set")), "small"
    )
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + in_small.count() // 20_000)
    likely = (
        in_small.join(sets.select("set", "n", "near"), "set")
        .withColumn("slot", F.pmod(F.xxhash64("path"), F.lit(slots)))
        .groupBy("slot")
        .applyInPandas(_likely_pairs, "a long, b long")
        .distinct()
    )
    in_large = None
    if large:
        every = large[0]
        for more in large[1:]:
            every = every.unionByName(more)
        in_large = materialise(every.distinct(), "large")
    crowds = None
    if in_large is not None and not in_large.isEmpty():
        crowds = materialise(_crowds(in_large), "crowds")
        # Pairs within a crowd are counted there.
        of = crowds.select("set", "crowd")
        likely = (
            likely.join(of.withColumnsRenamed({"set": "a", "crowd": "crowd_a"}), "a", "left")
            .join(of.withColumnsRenamed({"set": "b", "crowd": "crowd_b"}), "b", "left")
            .filter(F.coalesce(F.col("crowd_a") != F.col("crowd_b"), F.lit(True)))
            .select("a", "b")
        )
    likely = materialise(likely, "likely")
    groups = max(1, -(-likely.count() // PAIRS))
    # A pair goes to the group of its first set's smallest shingle, where most of its kin go as well.
    keyed = likely.join(sets.select(F.col("set").alias("a"), F.xxhash64(F.array_min("near")).alias("kin")), "a").select(
        "a", "b", F.pmod("kin", F.lit(4 * groups)).alias("group")
    )
    crowd = keyed.groupBy("group").agg(F.count("*").alias("pairs"))
    spread = F.pmod(F.xxhash64("a"), F.greatest(F.expr(f"pairs div {PAIRS}"), F.lit(1)))
    keyed = materialise(keyed.join(crowd, "group").select("a", "b", F.xxhash64("group", spread).alias("group")), "pairs")
    wanted = keyed.select(F.col("group").alias("slot"), F.col("a").alias("set")).union(keyed.select("group", "b")).distinct()

    needed = wanted.select("set")
    if crowds is not None:
        needed = needed.union(crowds.select("set"))
    # The full sets of those that are to be read, from one row each; a set may have no row with a doc_id.
    reading = needed.distinct().join(sets.select("set", "row", "x", "copies"), "set")
    texts = docs.select("text", _row()).join(reading, "row").select("text", "set", "copies", "x")
    full = texts.mapInArrow(_full_sets, "set long, copies long, s array<bigint>").groupBy("set").agg(
        F.first("s").alias("s"), F.first("copies").alias("copies")
    )
    full = materialise(full, "full")
    confirmed = (
        wanted.join(full, "set").groupBy("slot").cogroup(keyed.groupBy("group")).applyInPandas(_confirm, "a long, b long")
    )
    confirmed = materialise(confirmed, "confirmed")
    copies = sets.select("set", "copies")
    ends = confirmed.select(F.col("a").alias("set"), F.col("b").alias("other")).union(
        confirmed.select(F.col("b"), F.col("a"))
    )
    links = ends.join(copies.select(F.col("set").alias("other"), "copies"), "other").select("set", F.col("copies").alias("links"))
    edges = confirmed
    if crowds is not None:
        crowd_edges, crowd_links = _crowd_links(crowds, full)
        edges, links = edges.unionByName(crowd_edges), links.unionByName(crowd_links)
    labels = connected_components(edges)
    named = sets.select("set", "x", "y", "copies", "doc")
    heads = labels.join(named.select("set", "doc"), labels["node"] == F.col("set")).groupBy("component").agg(F.min("doc").alias("head"))
    classes = labels.join(heads, "component").select(F.col("node").alias("set"), "head")
    linked = links.groupBy("set").agg(F.sum("links").alias("links"))
    known = materialise(
        named.join(classes, "set", "left").join(linked, "set", "left").select(
            "x", "y", F.coalesce("head", "doc").alias("head"), "copies", F.coalesce("links", F.lit(0)).alias("links")
        ),
        "known",
    )
    placed = marked.select("doc_id", "x", "y").join(known, ["x", "y"]).select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.col("head")).alias("class_id"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"),
        (F.col("copies") - 1).alias("n_copies"),
    )
    blank = docs.filter(F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r")) == "")
    return placed.unionByName(
        blank.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_copies"))
    )


def one_of_each(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """`docs` with one document of each class: the one whose id is the class's.

    Blank texts and rows without a doc_id all stay. Repeated rows leave one, which costs a shuffle only
    where an id is there twice.
    """
    key = fresh_name("kept", docs)
    classes = near_duplicates(docs.select("doc_id", "text"), recall)
    kept = classes.filter(F.col("class_id").eqNullSafe(F.col("doc_id"))).select(F.col("doc_id").alias(key)).distinct()
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(F.col(key)), "left_semi")
    if docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return rows
    return rows.dropDuplicates(["doc_id", "text"])
