"""The whole pipeline against brute-force versions of its stages."""

import collections
import random
import re

import corpus_pipeline
import pytest
from test_operators import WORD, brute_links

from peerline.llm import pieces, pii, quality, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_quality(text):
    """Whether a text passes the threshold table."""
    ws, text = WORD.findall(text or ""), text or ""
    n, at = len(ws), collections.defaultdict(list)
    for i in range(n - 7):
        at[tuple(ws[i : i + 8])].append(i)
    repeated = len({j for starts in at.values() if len(starts) > 1 for i in starts for j in range(i, i + 8)})
    lines = [x for x in text.split("\n") if WORD.search(x)]
    stops = sum(w.strip(".,;:!?").lower() in quality.STOP_WORDS for w in ws)
    return (
        20 <= n <= 1_000_000 and 100 * repeated <= 30 * n and 2 * n <= sum(map(len, ws)) <= 12 * n
        and sum(c in quality.SYMBOLS for c in text) <= 0.1 * n and text.count("!") <= 0.2 * n
        and (n < 40 or stops >= 0.04 * n) and len(lines) - len(set(lines)) <= 0.4 * len(lines)
    )


def brute_targets(sizes, repeats=3):
    """Words each source is to give; what is above `repeats` times its size is shared out again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > repeats * sizes[s]]
        if not above:
            return share | held
        held |= {s: repeats * sizes[s] for s in above}


def planted(documents):
    """The given documents with copies, near copies, personal data, a source of its own and awkward rows."""
    random.seed(7)
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    good = [r for r in rows if brute_quality(r[1]) and len(r[1].split()) > 120][:30]
    for i, (_, text, lang, source, _) in enumerate(good):
        ws = text.split(" ")
        ws[random.randrange(len(ws))] = f"changed{i}"
        rows += [(20_000 + i, " ".join(ws), lang, source, None), (21_000 + i, text, lang, "copies", None)]
    mail = "write to jane.doe@mail.example.com or call +1 (663) 555-6869 and the rest is as it was before"
    rows += [(22_000 + i, f"{mail} " + " ".join(f"v{i}w{j} the" for j in range(40)), None, None, None) for i in range(9)]
    rows += [(23_000, None, None, None, None), (23_001, "", "en", "s", 0), (23_002, "too short", "en", "s", 9),
             (23_003, "the word " * 5000, "en", "s", 45_000), (None, "no id and too short", None, "s", None)]
    return rows


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    rows = planted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return rows, corpus_pipeline.run(spark, str(folder)).collect()


def expected(rows):
    good = [r for r in rows if brute_quality(r[1])]
    classes = brute_links([(r[0], r[1]) for r in good])
    return {r[0]: r for r in good if classes[r[0]][0] == r[0]}


def test_only_good_documents_without_near_copies_are_left(made):
    rows, out = made
    kept = expected(rows)
    assert {r.doc_id for r in out} <= set(kept)
    assert all((r.source, r.lang) == (kept[r.doc_id][3], kept[r.doc_id][2]) for r in out)
    assert not any(20_000 <= r.doc_id < 22_000 for r in out) and any(22_000 <= r.doc_id for r in out)


def test_texts_are_those_of_the_stages_before(spark, made):
    sentencepiece = pytest.importorskip("sentencepiece")
    rows, out = made
    kept = expected(rows)
    frame = spark.createDataFrame([(r[0], r[1]) for r in kept.values()], "doc_id long, text string")
    safe = {r.doc_id: r.text for r in pii.pseudonymise(frame).collect()}
    assert all(safe[d] == r[1] for d, r in kept.items() if not re.search(r"[\d@]", r[1]))
    model = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)
    coded = spark.createDataFrame([(r.doc_id, r.source, r.ids) for r in out], "doc_id long, source string, ids array<int>")
    taken, passes, cuts = collections.Counter(), collections.Counter(), collections.Counter()
    for r in pieces.decode(coded, queries.MODEL).collect():
        assert r.ids == model.encode(r.decoded)
        assert "jane.doe" not in r.decoded and "555-6869" not in r.decoded
        ws = WORD.findall(r.decoded)
        taken[r.source] += len(ws)
        if r.decoded == safe[r.doc_id]:
            passes[r.doc_id] += 1
        else:
            assert ws == WORD.findall(safe[r.doc_id])[: len(ws)]
            cuts[r.source] += 1
    sizes, by_source = collections.Counter(), collections.defaultdict(list)
    for d, r in kept.items():
        sizes[r[3]] += len(WORD.findall(r[1]))
        by_source[r[3]].append(passes[d])
    targets = brute_targets(sizes)
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in sizes)
    assert all(n <= 1 for n in cuts.values()) and all(max(x) <= 3 and max(x) - min(x) <= 1 for x in by_source.values())
    assert all(r.decoded_ok and r.n_tokens == len(r.ids) for r in out)


def test_no_documents_give_no_rows(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_return_the_columns_of_documents(spark, made, tmp_path):
    docs = spark.createDataFrame(made[0][:40], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
