"""SentencePiece models run by the tokenizers library: encode, decode, verify.

The model file is read field by field and rebuilt: normaliser, white-space marker, unigram scores or BPE merges,
byte fallback. Spark hands each task Arrow batches; a task encodes them in slices of bounded
size, so long texts and large batches don't pile up.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame

MARK = "▁"
# The model format's numbers for model types and piece types.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SLICE_CHARS = 400_000


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unknown: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True
    treat_whitespace_as_suffix: bool = False


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; lengths-delimited and fixed values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(wire)
        if wire == 2:
            size = varint()
        if size is None:
            raise ValueError(f"wire type {wire} is not part of the format")
        yield tag >> 3, data[at : at + size]
        at += size


def parse_model(data: bytes) -> Model:
    """The parts of a model file that decide how text becomes pieces."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            model.pieces.append(
                (piece.get(1, b"").decode(), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, NORMAL))
            )
        elif number == 2:
            trainer = dict(_fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.treat_whitespace_as_suffix = bool(trainer.get(24, 0))
            model.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.add_dummy_prefix = bool(spec.get(3, 1))
            model.remove_extra_whitespaces = bool(spec.get(4, 1))
            model.escape_whitespaces = bool(spec.get(5, 1))
    model.unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models hold scores or merges to rebuild")
    if model.treat_whitespace_as_suffix or not model.escape_whitespaces:
        raise ValueError("white space as a suffix or without a marker is not rebuilt")
    return model


def merges_of(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """BPE merges from scores: every way to make a piece of two others, best piece first, then by the parts' ids."""
    ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for piece, score, kind in pieces:
        if kind != NORMAL:
            continue
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                found.append((-score, ids[left], ids[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def marker_starts_pieces(model: Model) -> bool:
    """Whether no piece holds a marker after another character, so that text may be cut before each run of markers."""
    return not any(MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))


def build(model: Model):
    """A tokenizers.Tokenizer that gives the ids of the model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback)
    else:
        core = models.BPE(
            {p: i for i, (p, _, _) in enumerate(model.pieces)},
            merges_of(model.pieces),
            unk_token=model.pieces[model.unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if marker_starts_pieces(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        + ([decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else [])
    )
    defined = [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER_DEFINED]
    if defined:
        tokenizer.add_tokens(defined)
    return tokenizer


class _Codes(dict):
    """Segment -> place in the encoder's store; unseen segments get the next place and wait for the tokenizer."""

    def __init__(self) -> None:
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, segment: str) -> int:
        place = self[segment] = len(self)
        self.waiting.append(segment)
        return place


class Encoder:
    """Encodes lists of texts: cut before each run of markers, each distinct segment encoded once.

    A segment is known by what follows its marker, one with a run of markers by all of it. New segments go
    through the tokenizer together, strung into long texts that its threads share. The store of segments
    starts anew beyond `most_segments`, so its memory is bounded.
    """

    strung = 1000  # segments in a text

    def __init__(self, model: Model, most_segments: int = 500_000) -> None:
        self.model, self.tokenizer, self.most = model, build(model), most_segments
        defined = any(kind == USER_DEFINED for *_, kind in model.pieces)
        self.by_segment = model.add_dummy_prefix and marker_starts_pieces(model) and not defined
        self.folds = bool(model.charsmap) or model.remove_extra_whitespaces
        self.segments = re.compile(f"{MARK}+[^{MARK}]*")
        self.fast = build(model)
        self.fast.normalizer = _no_change()
        self.fast.pre_tokenizer = _before_markers()
        self.shown = [piece.replace(MARK, " ") for piece, _, _ in model.pieces]
        self.starts_segment = np.array([piece.startswith(MARK) for piece, _, _ in model.pieces])
        self.plain = np.array([kind in (NORMAL, USER_DEFINED) for *_, kind in model.pieces])
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()
        self.ids, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.good = np.zeros(0, bool)

    def _learn(self) -> None:
        new, self.codes.waiting = self.codes.waiting, []
        if not new:
            return
        chunks = [new[i : i + self.strung] for i in range(0, len(new), self.strung)]
        strings = ["".join([k if MARK in k else MARK + k for k in chunk]) for chunk in chunks]
        made, sizes = [], []
        for chunk, encoding in zip(chunks, self.fast.encode_batch_fast(strings, add_special_tokens=False)):
            ids = np.array(encoding.ids, np.int32)
            first = np.flatnonzero(self.starts_segment[ids])
            if len(first) != len(chunk):  # a run of markers, or a segment whose marker was merged into another piece
                each = [np.array(self._alone(k), np.int32) for k in chunk]
                ids, own = np.concatenate(each), np.array([len(x) for x in each])
            else:
                own = np.diff(np.append(first, len(ids)))
            made.append(ids)
            sizes.append(own)
        ids, sizes = np.concatenate(made), np.concatenate(sizes).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        self.good = np.concatenate([self.good, self._same(new, ids, starts, sizes)])
        self.ids, self.starts = np.concatenate([self.ids, ids]), np.concatenate([self.starts, starts + len(self.ids)])
        self.sizes = np.concatenate([self.sizes, sizes])

    def _alone(self, key: str) -> list[int]:
        segment = key if MARK in key else MARK + key
        held, self.fast.pre_tokenizer = self.fast.pre_tokenizer, self.tokenizer.pre_tokenizer
        try:
            return self.fast.encode(segment, add_special_tokens=False).ids
        finally:
            self.fast.pre_tokenizer = held

    def _same(self, keys: list[str], ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the ids of each segment read as the segment; bytes go through the decoder."""
        shown, out = self.shown, np.zeros(len(keys), bool)
        plain = np.logical_and.reduceat(self.plain[ids], starts)
        listed = ids.tolist()
        for i, (key, start, size, easy) in enumerate(zip(keys, starts.tolist(), sizes.tolist(), plain.tolist())):
            want = key.replace(MARK, " ") if MARK in key else " " + key
            own = listed[start : start + size]
            out[i] = ("".join([shown[x] for x in own]) if easy else " " + self.tokenizer.decode(own, skip_special_tokens=False)) == want
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """(sizes, all ids one after the other, whether each text comes back)."""
        if not self.by_segment:
            ids = [e.ids if t else [] for e, t in zip(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), texts)]
            back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            return sizes, np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum())), [a == b for a, b in zip(back, texts)]
        if len(self.codes) > self.most:
            self._forget()
        codes: list[int] = []
        counts, faithful = [], []
        for text in texts:
            if not text:
                segments = []
            elif self.folds or MARK in text or "  " in text or text[0] == " ":
                normal = self.tokenizer.normalizer.normalize_str(text)
                segments = [s[1:] if s[1:2] != MARK else s for s in self.segments.findall(normal)]
                faithful.append(MARK not in text and normal[1:].replace(MARK, " ") == text)
            else:
                segments = text.split(" ")
                faithful.append(True)
            if not text:
                faithful.append(True)
            codes += map(self.codes.__getitem__, segments)
            counts.append(len(segments))
        self._learn()
        at = np.array(codes, np.int64)
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        taken = self.ids[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        borders = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        of = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[borders])
        return of(sizes), taken, [bool(f and not b) for f, b in zip(faithful, of(~self.good[at]))]


def _no_change():
    from tokenizers import normalizers

    return normalizers.Sequence([])


def _before_markers():
    from tokenizers import pre_tokenizers

    return pre_tokenizers.Split(MARK, "merged_with_next")


@lru_cache(maxsize=2)
def _encoder(path: str, threads: int) -> Encoder:
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true" if threads > 1 else "false")
    with open(path, "rb") as f:
        return Encoder(parse_model(f.read()))


def _slices(texts: list, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` characters, one text at least."""
    first = held = 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > most:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def encode(docs: DataFrame, model_path: str, threads: int = 2, slice_chars: int = SLICE_CHARS, text: str = "text") -> DataFrame:
    """`docs` with `ids` (array<int>), `n_tokens` (long), `decoded_ok` (boolean) added.

    `decoded_ok` says whether the ids decode to the text again; a normaliser that folds white space or
    characters may change a text, and then it is false. Null and empty texts have no ids and
    decode to the empty text, null included. Repeated rows are encoded alike, no rows
    give no rows; columns of `docs` that carry an added name give way. `model_path` is sent along with the job.
    Encoding holds `slice_chars` characters at a time, or one text if that is longer.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(model_path)
    name = os.path.basename(model_path)
    added = {"ids": "array<int>", "n_tokens": "bigint", "decoded_ok": "boolean"}
    kept = docs.select(*[f"`{c}`" for c in docs.columns if c not in added])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + [f"{c} {t}" for c, t in added.items()])
    place, names = kept.columns.index(text), [*kept.columns, *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(SparkFiles.get(name), threads)
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            for first, last in _slices(texts, slice_chars):
                sizes, ids, good = encoder.encode(texts[first:last])
                columns = [batch.column(c).slice(first, last - first) for c in range(batch.num_columns)]
                columns += [
                    pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), ids),
                    pa.array(sizes, pa.int64()),
                    pa.array(good, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.mapInArrow(run, schema)


def decode(coded: DataFrame, model_path: str, threads: int = 2, slice_ids: int = SLICE_CHARS) -> DataFrame:
    """`coded` with `decoded` (string) added, the text of `ids`; null ids give null."""
    coded.sparkSession.sparkContext.addFile(model_path)
    name = os.path.basename(model_path)
    kept = coded.select(*[f"`{c}`" for c in coded.columns if c != "decoded"])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + ["decoded string"])
    place, names = kept.columns.index("ids"), [*kept.columns, "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _encoder(SparkFiles.get(name), threads).tokenizer
        for batch in batches:
            lists = batch.column(place).to_pylist()
            out: list[str | None] = []
            for first, last in _slices([i or [] for i in lists], slice_ids):
                texts = tokenizer.decode_batch([i or [] for i in lists[first:last]], skip_special_tokens=False)
                out += [t if i is not None else None for t, i in zip(texts, lists[first:last])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=names)

    return kept.mapInArrow(run, schema)
