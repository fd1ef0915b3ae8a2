"""Bytes that repeat: every 200-byte string that starts anywhere else is taken out of the documents.

Equal strings hold the same smallest 24-byte hash, so the windows of a document fall into segments of neighbouring
windows with one such key, and strings that repeat meet under it. Only keys seen twice go on. Under a key, equal segments
collapse to one with a weight; where segments differ, their shards are sorted apart, each into a
Burrows-Wheeler transform over 40-byte symbols, and the transforms are merged by interleave refinement: the
interleave starts as one shard after the other and every round reorders it by the symbols before the suffixes, without
looking at a suffix again. The places where the interleave is cut after round r are those where the
common prefix is shorter than 40 r bytes, so the uncut runs after five rounds are the repeated strings.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerline.llm.common import let
from peerline.session import materialise

LENGTH = 200  # bytes of a string that must not repeat
GRAM = 24  # bytes of the hashed pieces that make the keys
SYMBOL = 40  # bytes of a symbol of the transforms
SLICE = 1_000_000  # bytes that a task cuts at a time
BUCKET = 1_500_000  # bytes of segments merged in one group
SHARD = 400_000  # bytes of segments sorted as one shard
CROWD = 2048  # different segments under a key beyond which it is split by a further key
FALL = 0.75  # share of the crowded windows that a further key must not leave, or they go by their exact hash
FEW = 1_000_000  # crowded windows that go by their exact hash at once
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


class Rolling:
    """Polynomial hashes of any pieces of a buffer, modulo 2^64, mixed."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, n), out=self.sums[1:])
        self.back = _powers(INVERSE, n + 1)

    def every(self, size: int) -> np.ndarray:
        """Hash of the piece of `size` bytes at every place where it fits."""
        if len(self.sums) <= size:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64) * BASE)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every `size` neighbours."""
    held, width = values, 1
    while 2 * width <= size:
        held = np.minimum(held[:-width], held[width:])
        width *= 2
    rest = size - width
    return np.minimum(held[:-rest], held[rest:]) if rest else held


def segments(data: np.ndarray, sizes: np.ndarray, salt: int = 0) -> dict[str, np.ndarray]:
    """Segments of texts that lie one after the other in `data`: owner, key, content, first and last window start, times the key stands in it."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    windows = np.maximum(sizes - LENGTH + 1, 0)
    none = {k: np.zeros(0, np.int64) for k in ("owner", "key", "content", "first", "last", "times")}
    if not windows.any():
        return none
    rolling = Rolling(data)
    grams = rolling.every(GRAM)
    if salt:
        grams = mixed(grams ^ np.uint64(salt * 0x632BE59BD9B4E019 % 2**64))
    span = LENGTH - GRAM + 1
    least = _sliding_min(grams, span)
    owner = np.repeat(np.arange(len(sizes)), windows)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + starts[owner]
    key = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    first, last = at[head], at[tail]
    # Where the key stands: it opens a new minimum wherever its hash is met again within the segment.
    keyed = key[head]
    reach = last + span - 1
    lengths = reach - first + 1
    flat = np.arange(int(lengths.sum())) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
    times = np.add.reduceat((grams[flat] == np.repeat(keyed, lengths)).astype(np.int64), np.cumsum(lengths) - lengths)
    return {
        "owner": owner[head],
        "key": keyed.view(np.int64),
        "content": rolling.of(first, last + LENGTH).view(np.int64),
        "first": first - starts[owner[head]],
        "last": last - starts[owner[head]],
        "times": times,
    }


def binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, size of each)."""
    column = pc.fill_null(column.cast(pa.binary()), b"")
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8), sizes


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
        yield at, stop
        at = stop


def cut(rows: DataFrame, salt: int = 0) -> DataFrame:
    """Segments (id, first, last, times, key, content) of rows (id, text or bytes); another salt, another key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                data, sizes = binary(batch.column(1).slice(a, b - a))
                found = segments(data, sizes, salt)
                owner = found.pop("owner")
                if len(owner):
                    ids = batch.column(0).slice(a, b - a).take(pa.array(owner))
                    yield pa.RecordBatch.from_arrays(
                        [ids, *[pa.array(found[k].astype(np.int32)) for k in ("first", "last", "times")], *[pa.array(found[k]) for k in ("key", "content")]],
                        names=["id", "first", "last", "times", "key", "content"],
                    )

    return rows.mapInArrow(run, "id long, first int, last int, times int, key long, content long")


def _order(symbols: np.ndarray) -> np.ndarray:
    """Stable order of dense symbols: symbol and place in one number, sorted."""
    bits = np.uint64(max(1, int(len(symbols)).bit_length()))
    packed = (symbols.astype(np.uint64) << bits) | np.arange(len(symbols), dtype=np.uint64)
    packed.sort()
    return (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


class Transform:
    """One shard: its suffixes in order of their first `rounds` symbols, and the symbol before each (-1: none)."""

    def __init__(self, places: np.ndarray, before: np.ndarray, short: int) -> None:
        self.places, self.before, self.short = places, before, short


def transform(symbol: np.ndarray, here: np.ndarray, rounds: int) -> Transform:
    """Sort one shard. `symbol[p]` is the dense symbol at place p, -1 where none fits; `here` are the places of the shard.

    Suffixes without a whole symbol come first, as the shortest.
    """
    fits = symbol[here] >= 0
    short = here[~fits]
    order = here
    inside = np.zeros(len(symbol) + SYMBOL, bool)
    inside[here] = True
    for _ in range(rounds):
        before = order - SYMBOL
        ok = (before >= 0) & inside[before] & (symbol[before] >= 0)
        before = before[ok]
        order = np.concatenate([short, before[_order(symbol[before])]])
    before = order - SYMBOL
    ok = (before >= 0) & inside[before] & (symbol[before] >= 0)
    return Transform(order, np.where(ok, symbol[before], -1), len(short))


def interleave(shards: list[Transform], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each merged suffix, number of its run): suffixes of one run agree in their first `rounds` symbols."""
    sizes = np.array([len(s.places) for s in shards])
    z = np.repeat(np.arange(len(shards), dtype=np.int32), sizes)
    heads = np.repeat(np.arange(len(shards), dtype=np.int32), [s.short for s in shards])
    run = np.zeros(len(z), np.int64)
    before = np.concatenate([s.before for s in shards]) if shards else np.zeros(0, np.int64)
    for _ in range(rounds):
        # The j-th suffix of a shard in the interleave is the j-th of its transform.
        read = np.empty(len(z), np.int64)
        read[_order(z)] = np.arange(len(z))
        symbol = before[read]
        follows = np.flatnonzero(symbol >= 0)
        moved = follows[_order(symbol[follows])]
        z_next = np.concatenate([heads, z[moved]])
        changed = np.ones(len(z_next), bool)  # every short suffix is a run of its own
        if len(moved):
            changed[len(heads) + 1 :] = (symbol[moved][1:] != symbol[moved][:-1]) | (run[moved][1:] != run[moved][:-1])
        z, run = z_next, np.cumsum(changed) - 1
    return z, run


def repeated_windows(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Mask over the texts, one place after each added: where a 200-byte string starts that starts elsewhere too, or stands in a text of weight 2."""
    # One place after each text stands for its empty suffix.
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.frombuffer(b"".join([t + b"\0" for t in texts]), np.uint8)
    ends = np.cumsum(sizes) - 1
    owner = np.repeat(np.arange(len(texts)), sizes)
    hashes = Rolling(data).every(SYMBOL)
    symbol = np.full(len(data), -1, np.int64)
    inside = np.flatnonzero(np.arange(len(hashes)) + SYMBOL <= ends[owner[: len(hashes)]])
    symbol[inside] = np.unique(hashes[inside], return_inverse=True)[1]
    rounds = LENGTH // SYMBOL
    shards, start, held = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        held += size
        if held >= SHARD or i == len(texts) - 1:
            shards.append(transform(symbol, np.arange(start, int(ends[i]) + 1), rounds))
            start, held = int(ends[i]) + 1, 0
    z, run = interleave(shards, rounds)
    places = np.empty(len(z), np.int64)
    places[_order(z)] = np.concatenate([s.places for s in shards])
    whole = places + LENGTH <= ends[owner[places]]
    places, run = places[whole], run[whole]
    out = np.zeros(len(data), bool)
    if len(run):
        start = np.flatnonzero(np.diff(run, prepend=run[0] - 1))
        total = np.add.reduceat(weights[owner[places]], start)
        out[places[np.repeat(total, np.diff(np.append(start, len(run)))) > 1]] = True
    return out


def _merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Byte ranges (id, lo, hi) of one bucket's segments that repeat."""
    rows = rows.sort_values(["key", "id", "at"], kind="stable")
    texts = [bytes(t) for t in rows["bytes"]]
    mask = repeated_windows(texts, rows["weight"].to_numpy(np.int64))
    sizes = np.array([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    hit = np.flatnonzero(mask)
    if not len(hit):
        return pd.DataFrame({"id": [], "lo": [], "hi": []})
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) > 1) | (np.diff(owner[hit]) > 0)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(hit)) - 1
    who = owner[hit[head]]
    shift = rows["at"].to_numpy(np.int64)[who] - (np.cumsum(sizes) - sizes)[who]
    return pd.DataFrame({"id": rows["id"].to_numpy(np.int64)[who], "lo": hit[head] + shift, "hi": hit[tail] + shift + LENGTH})


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text after its ranges are taken out."""
    for batch in batches:
        out = []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = (text or "").encode()
            parts, at, spans, lost = [], 0, 0, 0
            last = -1
            for lo, hi in sorted((r["lo"], r["hi"]) for r in ranges):
                if lo > last:
                    spans += 1
                if hi <= at:
                    continue
                if lo > at:
                    parts.append(data[at:lo])
                lost += hi - max(lo, at)
                at = last = hi
            parts.append(data[at:])
            left = b"".join(parts)
            out.append((lost, spans, hashlib.sha256(left).hexdigest(), left))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.binary()))]],
            names=["id", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def _settled(found: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(segments that repeat whole, segments to be merged) of (id, first, last, times, weight, key, content).

    Keys that stand only once in all texts go first. Under the rest, a content that is there twice repeats whole, and if
    a key has several contents, or one that holds the key twice, one segment of each goes on with its weight.
    """
    often = found.groupBy("key").agg(F.sum(F.col("times") * F.col("weight")).alias("_n")).filter("_n > 1").select("key")
    met = materialise(found.join(often, "key"), f"{name}-met")
    contents = met.groupBy("key", "content").agg(
        F.sum("weight").alias("weight"), F.max("times").alias("times"), F.min(F.struct("id", "first", "last")).alias("one")
    )
    contents = materialise(contents, f"{name}-contents")
    twice = contents.filter("weight > 1").select("key", "content")
    whole = met.join(twice, ["key", "content"]).select("id", "first", "last")
    room = F.sum(F.col("one.last") - F.col("one.first") + LENGTH)
    keys = contents.groupBy("key").agg(F.count("*").alias("contents"), F.max("times").alias("most"), room.alias("room"))
    keys = keys.filter((F.col("contents") > 1) | (F.col("most") > 1)).select(
        "key", ((F.col("contents") > CROWD) | (F.col("room") > BUCKET)).alias("crowded")
    )
    going = contents.join(keys, "key").select("key", "weight", "crowded", "one.id", "one.first", "one.last")
    return whole, materialise(going, f"{name}-going")


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, place, weight, hash) of every window of segments (id, bytes, at, weight, key)."""
    for batch in batches:
        for a, b in slices(batch.column(1)):
            data, sizes = binary(batch.column(1).slice(a, b - a))
            ids, at, weight, key = (batch.column(c).slice(a, b - a).to_numpy(zero_copy_only=False) for c in (0, 2, 3, 4))
            counts = sizes - LENGTH + 1
            owner = np.repeat(np.arange(len(sizes)), counts)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            hashes = Rolling(data).every(LENGTH)[(np.cumsum(sizes) - sizes)[owner] + place]
            hashes = mixed(hashes ^ key.view(np.uint64)[owner])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[owner]), pa.array(at[owner] + place), pa.array(weight[owner]), pa.array(hashes.view(np.int64))],
                names=["id", "place", "weight", "hash"],
            )


def _by_window(own: DataFrame) -> DataFrame:
    """Byte ranges (id, lo, hi) of the windows of crowded segments that repeat, met by their exact hash over all tasks."""
    every = own.select("id", "bytes", F.col("at").cast("long"), "weight", "key").mapInArrow(
        _windows, "id long, place long, weight long, hash long"
    )
    every = materialise(every, "windows")
    often = materialise(every.groupBy("hash").agg(F.sum("weight").alias("_n")).filter("_n > 1").select("hash"), "often")
    # Neighbouring places become one range; cut, so that no list grows with a text.
    listed = every.join(often, "hash").groupBy("id", F.expr(f"place div {BUCKET // 100}")).agg(F.sort_array(F.collect_set("place")).alias("at"))
    edges = lambda step: F.filter("at", lambda p, i: F.coalesce(F.get("at", i + step) != p + step, F.lit(True)))
    ends = listed.select("id", F.explode(F.arrays_zip(edges(-1).alias("lo"), edges(1).alias("hi"))).alias("r"))
    return ends.select("id", F.col("r.lo").alias("lo"), (F.col("r.hi") + LENGTH).alias("hi"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left, null where nothing was taken out).

    Strings are judged on the input; matches never cross documents. A null text is empty; texts under 200 bytes lose
    nothing. Rows alike in doc_id and text repeat each other, as any two equal texts do. Equality is that of 64-bit hashes of
    the segments and of the five symbols in a row.

    A key with more than `CROWD` different segments, as a passage shared by many documents has at its edges, or with more
    than `BUCKET` bytes of them, is cut again by further, independent keys for as long as they leave clearly fewer windows
    in crowds; the windows that no key divides meet by their exact hash. So no group outgrows these bounds, however many
    documents share a passage. A text's ranges are gathered per document.
    """
    rows = docs.select(F.xxhash64("doc_id", "text").alias("id"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = materialise(cut(rows.select("id", "text")), "segments").withColumn("weight", F.lit(1).cast("long"))
    whole, going = _settled(found, "first")
    asked = going.groupBy("id").agg(F.collect_list(F.struct("key", "weight", "crowded", "first", "last")).alias("asked"))
    touched = whole.select("id").union(going.select("id")).distinct().join(asked, "id", "left")
    held = materialise(rows.select("id", "text").join(touched, "id"), "held")

    def piece(data, s):
        return F.struct(
            s["key"].alias("key"), s["weight"].alias("weight"), s["crowded"].alias("crowded"), s["first"].alias("at"),
            F.substr(data, s["first"] + 1, s["last"] - s["first"] + LENGTH).alias("bytes"),
        )

    pieces = held.filter(F.size("asked") > 0).select(
        "id", F.explode(let(F.col("text").cast("binary"), lambda data: F.transform("asked", lambda s: piece(data, s)))).alias("p")
    )
    pieces = materialise(pieces.select("id", "p.*").distinct(), "pieces")
    ranges = whole.select("id", F.col("first").cast("long").alias("lo"), (F.col("last") + LENGTH).cast("long").alias("hi"))
    plain = pieces.filter("not crowded").select("key", "id", "at", "weight", "bytes")
    crowded = pieces.filter("crowded")
    salt, before = 0, math.inf
    while not crowded.isEmpty():
        own = materialise(
            crowded.select(F.monotonically_increasing_id().alias("row"), "key", "id", "at", "weight", "bytes"), "crowded"
        )
        windows = own.agg(F.sum(F.octet_length("bytes") - LENGTH + 1)).first()[0]
        if windows <= FEW or windows > FALL * before:
            ranges = ranges.union(_by_window(own))
            break
        salt, before = salt + 1, windows
        inner = cut(own.select("row", "bytes"), salt=salt).withColumnRenamed("id", "row")
        inner = inner.join(own.select("row", F.col("key").alias("under"), "weight"), "row").select(
            F.col("row").alias("id"), "first", "last", "times", "weight", F.xxhash64("under", "key").alias("key"), "content"
        )
        inner_whole, inner_going = _settled(materialise(inner, "further"), "further")
        back = own.select(F.col("row").alias("_row"), F.col("id").alias("_doc"), "at", "bytes")
        placed = inner_whole.join(back.drop("bytes"), F.col("id") == F.col("_row"))
        ranges = ranges.union(
            placed.select(F.col("_doc"), (F.col("at") + F.col("first")).cast("long"), (F.col("at") + F.col("last") + LENGTH).cast("long"))
        )
        cut_again = inner_going.join(back, F.col("id") == F.col("_row")).select(
            "key", F.col("_doc").alias("id"), (F.col("at") + F.col("first")).alias("at"), "weight", "crowded",
            F.substr("bytes", F.col("first") + 1, F.col("last") - F.col("first") + LENGTH).alias("bytes"),
        )
        cut_again = materialise(cut_again, "pieces")
        plain = plain.union(cut_again.filter("not crowded").drop("crowded"))
        crowded = cut_again.filter("crowded")
    plain = materialise(plain, "merging")
    size = plain.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    buckets = 1 + size // BUCKET
    merged = plain.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket").applyInPandas(_merge, "id long, lo long, hi long")
    ranges = ranges.union(merged)
    gathered = ranges.distinct().groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    left = held.select("id", "text").join(gathered, "id").mapInArrow(
        _without, "id long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    ).dropDuplicates(["id"])
    whole_rows = rows.select("id", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("_sha"))
    return whole_rows.join(left, "id", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "_sha").alias("kept_sha256"),
        "kept",
    )
