"""Document scores from a log-bilinear neural language model, and from smoothed token counts.

Tokens fall into classes: each of the most frequent words is one, all other words share hashed classes. The network
predicts the next class from the two before it, as a sum of bilinear terms, and is trained with
noise-contrastive estimation over every training token: tasks train on their own rows and their
parameters are averaged, weighted by tokens, after every round. Because the score is a sum of one term for
each context place, two class-by-class tables hold all scores, and one matrix product of their exponentials gives
every normaliser, so the probabilities are exact. A word of a shared class has its class's
probability times its share of the class by counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerline.session import materialise

END = b"\n"  # no word holds a line break
TOP = 1023  # words with a class of their own
SHARED = 256  # hashed classes of all other words
WIDTH = 16
NOISE = 64
BATCH = 1024
ROUNDS = 2
RATE = 0.3
LEAST_STEPS = 2_000_000  # tokens the network sees at least: it goes through a smaller corpus several times
MOST_PASSES = 20
KNOWN = 65_536  # frequent tokens whose counts every task holds, at most; the rest are joined
OCTAVE = 16  # steps in which counts are told apart when the frequent ones are picked
LONGEST = 64  # bytes of a token in that table
COUNT_BYTES = 48_000_000  # bytes of words that a task counts at a time
TRAIN_BYTES = 4_000_000
SCORE_BYTES = 2_000_000


def word_lists(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of words of each text, all words one after the other): A-Z lowered, cut at the six ASCII white-space characters."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))
    words = lists.flatten()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(words):
        empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
        if empty.any():  # a text without words is cut into one empty piece
            owners = np.repeat(np.arange(len(sizes)), sizes)[empty]
            sizes = sizes - np.bincount(owners, minlength=len(sizes))
            words = words.filter(pa.array(~empty))
    return sizes, words.cast(pa.binary())


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about `most` bytes, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, stop
        at = stop


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is divisible by 10; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def count_tokens(train: DataFrame) -> DataFrame:
    """(token binary, n) over all rows; each task adds up before it sends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Array] = []
        rows = held = 0

        def flush() -> pa.RecordBatch:
            counted = pa.concat_arrays(waiting).value_counts()
            return pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], names=["token", "n"])

        for batch in batches:
            rows += len(batch)
            for at, stop in slices(batch.column(0), COUNT_BYTES):
                _, words = word_lists(batch.column(0).slice(at, stop - at))
                waiting.append(words)
                held += words.nbytes
                if held > COUNT_BYTES:
                    yield flush()
                    waiting, held = [], 0
        if held:
            yield flush()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([rows], pa.int64())], names=["token", "n"])

    return train.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Classes:
    """Token -> class: 0 before the text, 1 to `own` for tokens of their own, hashed ones above.

    `listed` holds the tokens that are looked up at once; all others are hashed one by one.
    """

    def __init__(self, own: list[bytes], shared: int, listed: list[bytes] = ()) -> None:
        self.first, self.shared = len(own) + 1, shared
        mine = {t: i + 1 for i, t in enumerate(own)}
        self.listed = list(dict.fromkeys([END, *own, *listed]))
        self.values = pa.array(self.listed, pa.binary())
        self.of_place = np.array([mine.get(t) or self.hashed(t) for t in self.listed], np.int64)

    def hashed(self, token: bytes) -> int:
        return self.first + zlib.crc32(token) % self.shared

    @property
    def size(self) -> int:
        return self.first + self.shared

    def runs(self, texts: pa.Array) -> Runs:
        sizes, words = word_lists(texts)
        encoded = words.dictionary_encode()
        place = pc.fill_null(pc.index_in(encoded.dictionary, value_set=self.values), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        classes = self.of_place[place]
        unlisted = np.flatnonzero(place < 0)
        classes[unlisted] = [self.hashed(t) for t in encoded.dictionary.take(pa.array(unlisted)).to_pylist()]
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        begun = np.cumsum(sizes + 3) - (sizes + 3)
        at = np.arange(len(words)) + np.repeat(begun + 2 - (np.cumsum(sizes) - sizes), sizes)
        flat, found = np.zeros(len(words) + 3 * len(sizes), np.int64), np.zeros(len(words) + 3 * len(sizes), np.int64)
        flat[at], found[at] = classes[codes], place[codes]
        ends = begun + 2 + sizes
        flat[ends] = self.of_place[0]
        targets = np.ones(len(flat), bool)
        targets[begun] = targets[begun + 1] = False
        targets = np.flatnonzero(targets)
        return Runs(flat, targets, sizes + 1, found[targets], words)


@dataclass
class Runs:
    """Classes of all texts, two starts before each and an end after; where the tokens stand; tokens a text; their places in the list or -1."""

    classes: np.ndarray
    targets: np.ndarray
    sizes: np.ndarray
    found: np.ndarray
    words: pa.Array


@dataclass
class Network:
    """Class vectors for both context places and the target, one column a class, and a bias."""

    one: np.ndarray
    two: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, weights: np.ndarray, width: int, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        shape = (width, len(weights))
        return cls(
            *(rng.normal(0, 0.1, shape).astype(np.float32) for _ in range(3)),
            np.log(np.maximum(weights, 1e-9)).astype(np.float32),
        )

    def pack(self) -> np.ndarray:
        return np.concatenate([self.one.ravel(), self.two.ravel(), self.out.ravel(), self.bias])

    @classmethod
    def unpack(cls, flat: np.ndarray, width: int) -> Network:
        n = len(flat) // (3 * width + 1)
        one, two, out = (flat[i * n * width : (i + 1) * n * width].reshape(width, n) for i in range(3))
        return cls(one.copy(), two.copy(), out.copy(), flat[3 * n * width :].copy())

    def learn(self, c1: np.ndarray, c2: np.ndarray, target: np.ndarray, noise: np.ndarray, log_noise: np.ndarray, sums: Network) -> None:
        """One step of noise-contrastive estimation; the noise classes are shared by the batch. `sums` holds squared gradients."""
        n, log_k = len(self.bias), np.float32(math.log(len(noise)))
        h = np.take(self.one, c1, 1)
        h += np.take(self.two, c2, 1)
        wanted, offered = np.take(self.out, target, 1), self.out[:, noise]
        said = np.einsum("ij,ij->j", h, wanted) + np.take(self.bias - log_noise, target) - log_k
        right = _sigmoid(-said)
        wrong = offered.T @ h
        wrong += (self.bias[noise] - log_noise[noise] - log_k)[:, None]
        wrong = -_sigmoid(wrong)
        wanted *= right
        dh = wanted
        dh += offered @ wrong

        def gather(where: np.ndarray, values: np.ndarray) -> np.ndarray:
            return np.stack([np.bincount(where, row, n) for row in values])

        grad_context = gather(c1, dh), gather(c2, dh)
        grad_out = gather(target, h * right)
        np.add.at(grad_out.T, noise, wrong @ h.T)
        grad_bias = np.bincount(target, right, n) + np.bincount(noise, wrong.sum(1), n)
        for name, grad in (("one", grad_context[0]), ("two", grad_context[1]), ("out", grad_out), ("bias", grad_bias)):
            grad = (grad / math.sqrt(len(target))).astype(np.float32)
            held = getattr(sums, name)
            held += grad * grad
            getattr(self, name)[...] += RATE * grad / np.sqrt(held + 1e-6)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (class before, class), by (class before that, class) with the bias, and log normalisers by both.

        Class 0, the place before a text, is never predicted.
        """
        first = self.one.T @ self.out[:, 1:]
        second = self.two.T @ self.out[:, 1:] + self.bias[1:]
        top1, top2 = first.max(1, keepdims=True), second.max(1, keepdims=True)
        total = np.exp(first - top1) @ np.exp(second - top2).T
        return first, second, np.log(np.maximum(total, 1e-30)) + top1 + top2.T


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: DataFrame, own: list[bytes], listed: list[bytes], weights: np.ndarray, shared: int = SHARED, width: int = WIDTH, rounds: int = ROUNDS, passes: int = 1) -> Network:
    """The network after every training row was seen `passes` times; round r takes the rows whose hash falls to it.

    Each task sends its parameters, of a size fixed by classes and width. They are added up in about the
    square root of their number of groups, and those sums are averaged on the driver.
    """
    context = rows.sparkSession.sparkContext
    network = Network.start(weights, width)
    log_noise = np.log(np.maximum(weights, 1e-9)).astype(np.float32)
    rows = rows.select("text", F.pmod(F.xxhash64("text"), F.lit(rounds)).alias("turn"))
    steps = np.cumsum(weights[1:] / weights[1:].sum())
    for turn in range(rounds):
        begun = context.broadcast((network.pack(), own, listed, steps, log_noise))

        def run(batches: Iterator[pa.RecordBatch], begun=begun) -> Iterator[pa.RecordBatch]:
            flat, names, often, odds, noise_logs = begun.value
            net, classes = Network.unpack(flat, width), Classes(names, shared, often)
            sums = Network.unpack(np.full(len(flat), 0.1, np.float32), width)
            rng = np.random.default_rng(11)
            seen, waiting, held = 0, [], 0

            def flush() -> int:
                made = classes.runs(pa.concat_arrays(waiting))
                runs, places = made.classes, made.targets
                for _ in range(passes):
                    order = rng.permutation(places)
                    for start in range(0, len(order), BATCH):
                        at = order[start : start + BATCH]
                        noise = 1 + np.searchsorted(odds, rng.random(NOISE)).clip(0, len(odds) - 1)
                        net.learn(runs[at - 1], runs[at - 2], runs[at], noise, noise_logs, sums)
                return len(places)

            for batch in batches:
                for at, stop in slices(batch.column(0), TRAIN_BYTES):
                    waiting.append(batch.column(0).slice(at, stop - at))
                    held += waiting[-1].nbytes
                    if held > TRAIN_BYTES:
                        seen += flush()
                        waiting, held = [], 0
            if waiting:
                seen += flush()
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rng.integers(1 << 30)]), pa.array([float(seen)]), pa.array([(net.pack() * np.float32(seen)).astype(np.float64).tobytes()], pa.binary())],
                    names=["part", "seen", "net"],
                )

        made = materialise(
            rows.filter(F.col("turn") == turn).select("text").mapInArrow(run, "part long, seen double, net binary"), "networks"
        )
        groups = max(1, math.isqrt(made.count()))

        def add(parts: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(len(parts["net"].iloc[0]) // 8)
            for net in parts["net"]:
                total += np.frombuffer(net)
            return pd.DataFrame({"seen": [parts["seen"].sum()], "net": [total.tobytes()]})

        numbered = made.withColumn("slot", F.pmod(F.xxhash64("seen", "net"), F.lit(groups)))
        summed = numbered.groupBy("slot").applyInPandas(add, "seen double, net binary").collect()
        if summed:
            total = sum(np.frombuffer(r["net"]) for r in summed) / sum(r["seen"] for r in summed)
            network = Network.unpack(total.astype(np.float32), width)
        begun.unpersist()
    return network


def frequent_tokens(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """Tokens of at most `LONGEST` bytes with the largest counts, in falling order; the end of a text is always among them.

    A count from which no more than `most` tokens go up is found from a few hundred sums, so that no more than `most`
    rows are ever sent.
    """
    ends = [r[0] for r in counts.filter(F.col("token") == F.lit(bytearray(END))).select("n").collect()]
    words = counts.filter((F.octet_length("token") <= LONGEST) & (F.col("token") != F.lit(bytearray(END))))
    step = F.floor(F.log2("n") * OCTAVE)
    taken, least = 0, None
    for r in words.groupBy(step.alias("step")).agg(F.count("*").alias("tokens")).orderBy(F.desc("step")).collect():
        taken += r["tokens"]
        if taken > most:
            break
        least = r["step"]
    listed = [] if least is None else [(bytes(r[0]), r[1]) for r in words.filter(step >= least).select("token", "n").collect()]
    return [(END, n) for n in ends] + sorted(listed, key=lambda x: (-x[1], x[0]))


def score(docs: DataFrame, top: int = TOP, shared: int = SHARED, width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document.

    Learns from the documents that are not held out. A null text counts as empty and has one token, the end.
    Repeated rows count and are scored each on its own. Without training rows every count is 0 and the network is
    untrained. Token counts stay in a table; only up to `KNOWN` frequent tokens of at most `LONGEST` bytes are sent to all tasks, the counts
    of all others are joined. Only doc_id and text are read; other columns may have any name. With all training tokens N and V distinct ones,
    base_score adds log10((c + 0.1) / (N + 0.1 (V + 1))).
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    learned = rows.filter(~F.col("held_out"))
    counts = materialise(count_tokens(learned), "counts")
    n_all, n_distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = frequent_tokens(counts, KNOWN)
    own = [t for t, _ in frequent if t != END][:top]
    own.append(END)
    classes = Classes(own, shared)
    known = dict(frequent)
    # Mass of each shared class: counts of its tokens plus 0.1 each, and 0.1 for all that was never seen.
    hashed = F.lit(classes.first) + F.crc32("token") % shared
    masses = np.full(classes.size, 0.1)
    for r in counts.join(_frame(docs, own), "token", "left_anti").groupBy(hashed.alias("c")).agg(F.sum(F.col("n") + 0.1)).collect():
        masses[r[0]] += r[1]
    weights = masses.copy()
    for i, token in enumerate(own, 1):
        weights[i] = known.get(token, 0) + 0.1
    weights[0] = 0.1
    weights = (weights / weights.sum()).astype(np.float64)
    passes = min(MOST_PASSES, max(1, -(-LEAST_STEPS // max(n_all, 1))))
    network = train(learned, own, list(known), weights, shared, width, rounds, passes)
    first, second, norms = network.tables()
    sent = context.broadcast((own, known, first, second, norms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counted, one, two, norm = sent.value
        by_class = Classes(names, shared, list(counted))
        edge = by_class.first
        # log10(c + 0.1) of each listed token; the last place stands for the tokens that are joined later.
        values = np.array([math.log10(counted.get(t, 0) + 0.1) for t in by_class.listed] + [0.0])
        seen = np.array([counted.get(t, 0) > 0 for t in by_class.listed] + [False]).astype(np.int64)
        for batch in batches:
            for at, stop in slices(batch.column(1), SCORE_BYTES):
                runs = by_class.runs(batch.column(1).slice(at, stop - at))
                c, c1, c2 = (runs.classes[runs.targets - i] for i in range(3))
                base = values[runs.found]
                logs = (one[c1, c - 1] + two[c2, c - 1] - norm[c1, c2]) / math.log(10)
                logs = logs + np.where(c >= edge, base - log_masses[c], 0.0)
                starts = np.cumsum(runs.sizes) - runs.sizes
                of = lambda x: np.add.reduceat(x, starts)
                lost = runs.found < 0
                owners = np.repeat(np.arange(len(starts)), runs.sizes)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owners[lost], minlength=len(starts)))]).astype(np.int32)
                is_end = np.zeros(len(lost), bool)
                is_end[starts + runs.sizes - 1] = True
                rest = runs.words.filter(pa.array(lost[~is_end]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, stop - at),
                        batch.column(2).slice(at, stop - at),
                        pa.array(runs.sizes, pa.int64()),
                        pa.array(of(seen[runs.found]), pa.int64()),
                        pa.array(of(base), pa.float64()),
                        pa.array(of(logs.astype(np.float64)), pa.float64()),
                        pa.ListArray.from_arrays(offsets, rest),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "known", "base", "model", "rest"],
                )

    log_masses = np.log10(masses)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, model double, rest array<binary>"
    scored = materialise(
        rows.select("doc_id", "text", "held_out").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored"
    )
    # Tokens beyond the table: their counts are joined and what they add comes back to the row.
    left = scored.select("row", F.explode("rest").alias("token"))
    valued = left.join(counts, "token", "left").select("row", F.coalesce("n", F.lit(0)).alias("n"))
    added = valued.groupBy("row").agg(
        F.sum(F.log10(F.col("n") + 0.1)).alias("more"),
        F.count(F.when(F.col("n") > 0, 1)).alias("more_known"),
    )
    more = F.coalesce("more", F.lit(0.0))
    whole = math.log10(n_all + 0.1 * (n_distinct + 1))
    return scored.drop("rest").join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )


def _frame(docs: DataFrame, tokens: list[bytes]) -> DataFrame:
    return docs.sparkSession.createDataFrame([(bytearray(t),) for t in tokens], "token binary")
