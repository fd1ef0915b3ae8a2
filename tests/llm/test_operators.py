"""Each operator against a brute-force version, and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from compare import difference
from pyspark.sql import functions as F

from peerline.llm import block_topk, bwt_repeats, chosen_path, licences, mixing, neural_lm, pieces, pii, preferences, quality, queries

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
AWKWARD = [
    (1, None, "s", None), (2, "", "s", 0), (3, " \n\t ", None, 3), (4, "one", "s", 3), (4, "one", "s", 3),
    (5, "a b c d e f g h " * 400, "t", 1), (None, "no id here", "t", 9), (6, "x" * 5000, "t", 5000),
]
SCHEMA = "doc_id long, text string, source string, n_words long"  # n_words clashes with what operators add


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), queries.ORACLE[name], FOLDER) is None


# --- pseudonyms -------------------------------------------------------------


def test_pseudonyms_keep_format_rules_and_links(spark):
    rows = [
        (1, "a.b@mail2.example.com pays 4111111111111111, +1 (663) 555-6869"),
        (2, "4111111111111111 again, 10.0.0.255, 1984-02-29, 31.12.1999, 30.02.2001, DE89370400440532013000, 123-45-6789"),
        (3, None), (4, ""), (5, "clean words only"), (5, "clean words only"),
    ]
    got = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[3].text is None and got[4].text == "" and got[5].text == "clean words only" and got[5].n_found == 0
    card = re.search(r"pays (\d{16}),", got[1].text)[1]
    assert card != "4111111111111111" and got[2].text.startswith(card)
    digits = [int(d) for d in reversed(card)]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", got[1].text) and "555-6869" not in got[1].text
    _, _, ip, leap, day, wrong, iban, ssn = [x.strip(",") for x in got[2].text.split()]
    assert all(0 <= int(o) < 256 for o in ip.split(".")) and ip != "10.0.0.255"
    assert int(leap[:4]) % 4 == 0 and re.fullmatch(r"\d\d\.\d\d\.\d{4}", day) and wrong == "30.02.2001"
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and iban[:2] == "DE"
    assert re.fullmatch(r"\d{3}-\d\d-\d{4}", ssn)
    assert got[1].n_email == got[1].n_phone == got[1].n_card == 1


def test_pseudonyms_of_upper_case_keys_and_month_first_dates(spark):
    values = ["9233A8EC" * 4, "9233a8ec" * 5, "12/25/2021", "02-29-2024", "02/30/2021", "10/11/2021"]
    docs = spark.createDataFrame([(k, v, "x", 7) for k, v in enumerate(values * 2)], "doc_id long, text string, found string, n_words long")
    rows = pii.pseudonymise(docs).orderBy("doc_id").collect()
    got = [r.text for r in rows]
    assert got[: len(values)] == got[len(values) :] and {r.found for r in rows} == {"x"}
    upper, lower, date, leap, wrong, day_first = got[: len(values)]
    assert re.fullmatch("[0-9A-F]{32}", upper) and upper != values[0] and re.fullmatch("[0-9a-f]{40}", lower) and lower != values[1]
    assert 1 <= int(date[:2]) <= 12 and 1 <= int(date[3:5]) <= 31 and date != values[2]
    assert int(leap[6:]) % 4 == 0 and 1 <= int(leap[:2]) <= 12 and wrong == values[4]
    assert 1 <= int(day_first[:2]) <= 31 and 1 <= int(day_first[3:5]) <= 12
    assert pii.pseudonymise(docs, "one key").first().text != pii.pseudonymise(docs, "another").first().text
    assert pii.pseudonymise(docs.limit(0)).count() == 0 and pii.session_key(spark) == pii.session_key(spark)


def test_pseudonyms_agree_with_a_plain_feistel_network(spark):
    """Access keys and addresses, by a network written out in plain Python."""

    def digest(kind, i, half):
        return "".join(hashlib.sha256(f"k|{kind}.{n}|{i}|{half}".encode()).hexdigest() for n in (0, 1))

    def shift(text, stream):
        out = []
        for i, c in enumerate(text):
            by = int(stream[2 * (i % 64) : 2 * (i % 64) + 2], 16)
            low, size = (48, 10) if c.isdigit() else (97, 26) if c.islower() else (65, 26)
            out.append(chr(low + (ord(c) - low + by) % size))
        return "".join(out)

    def access(value):
        left, right = value[: len(value) // 2], value[len(value) // 2 :]
        for i in range(1, pii.ROUNDS + 1):
            left, right = right, shift(left, digest("access", i, right))
        return left + right

    def address(value):
        a, b, c, d = map(int, value.split("."))
        left, right = a * 256 + b, c * 256 + d
        for i in range(1, pii.ROUNDS + 1):
            if i % 2:
                left = (left + int(digest("ip", i, right)[:15], 16)) % 65536
            else:
                right = (right + int(digest("ip", i, left)[:15], 16)) % 65536
        return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"

    some = random.Random(8)
    keys = ["".join(some.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16)) for _ in range(40)]
    hosts = [".".join(str(some.randrange(256)) for _ in range(4)) for _ in range(40)]
    docs = spark.createDataFrame([(k, f"use AKIA{a} at {b}, twice {b}") for k, (a, b) in enumerate(zip(keys, hosts))], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.pseudonymise(docs, "k").collect()}
    assert got == {k: f"use AKIA{access(a)} at {address(b)}, twice {address(b)}" for k, (a, b) in enumerate(zip(keys, hosts))}


def test_pseudonyms_are_a_permutation(spark):
    cards = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("card 4"), F.lpad(F.col("id").cast("string"), 12, "0")).alias("text"))
    assert pii.pseudonymise(cards).select("text").distinct().count() == 2000


# --- pieces -----------------------------------------------------------------


def test_pieces_agree_with_the_reference_library(spark, documents, awkward):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)
    docs = documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    odd = spark.createDataFrame([(90, "  two  spaces "), (91, "日本 😀 \x00 <s>"), (92, "é" * 300)], "doc_id long, text string")
    coded = pieces.encode(docs.unionByName(odd), queries.MODEL).collect()
    assert all(r.ids == model.encode(r.text or "") and r.n_tokens == len(r.ids) and r.decoded_ok for r in coded)
    assert len(coded) == documents.count() + len(AWKWARD) + 3
    frame = spark.createDataFrame([(r.text, r.ids) for r in coded if r.text], "text string, ids array<int>")
    assert pieces.decode(frame, queries.MODEL).filter("decoded <> text").count() == 0


def test_a_unigram_model_is_rebuilt():
    def field(number, value):
        return bytes([number << 3 | 2, len(value)]) + value

    import struct

    vocabulary = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("▁ab", -1.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("c", -3.5, 1)]
    data = b"".join(field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + bytes([24, k])) for p, s, k in vocabulary)
    model = pieces.parse_model(data + field(2, bytes([24, 1])) + field(3, bytes([24, 1, 32, 0, 40, 1])))
    encoder = pieces.Encoder(model)
    sizes, ids, good = encoder.encode(["ab c", "", "ab"])
    assert ids.tolist() == [2, 1, 5, 2] and sizes.tolist() == [3, 0, 1] and good == [True] * 3


# --- preferences ------------------------------------------------------------


def test_preferences(spark):
    turns = [
        (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "b"), (2, 0, "user", "q"), (2, 1, "assistant", "a"),
        (2, 2, "user", "c"), (2, 2, "user", "c"), (2, 3, "assistant", "d"), (3, 0, "user", "q"), (None, 0, "user", "x"),
        (4, None, "user", "x"), (5, 0, None, None),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    pairs = preferences.pair_by_opening(preferences.clean_turns(frame))
    got = sorted(
        ((r.pair_id, r.part, r.conv_id, r.turn, r.loss_mask, r.prefix_turns, r.paired) for r in preferences.format_preferences(frame, pairs).collect())
    )
    assert got == [
        (1, "chosen", 1, 2, 0, 2, True), (1, "prompt", 1, 0, 0, 2, True), (1, "prompt", 1, 1, 0, 2, True),
        (1, "rejected", 2, 2, 0, 2, True), (1, "rejected", 2, 3, 1, 2, True), (3, "chosen", 3, 0, 0, 0, False),
        (5, "chosen", 5, 0, 0, 0, False),
    ]
    none = frame.limit(0)
    assert preferences.format_preferences(none, preferences.pair_by_opening(none)).count() == 0


def brute_replies(rows):
    """pair_id: (prompt, chosen, masks of chosen, rejected), rejected as a set of possible texts."""
    convs, out = {}, {}
    for c, t, r, x in {x for x in rows if x[0] is not None and x[1] is not None}:
        convs.setdefault(c, {}).setdefault(t, set()).add((r, x))
    last = {c: max((t for t in ts if any(r == "assistant" for r, _ in ts[t])), default=None) for c, ts in convs.items()}
    replies = {c: frozenset(convs[c][t]) for c, t in last.items() if t is not None}
    for c, ts in convs.items():
        others = {r for r in replies.values() if c in replies and r != replies[c]}
        fork = last[c] if others else None
        flat = lambda keep: sorted((t, *x) for t in ts if keep(t) for x in ts[t])  # noqa: B023, E731
        out[c] = (flat(lambda t: fork is not None and t < fork), flat(lambda t: fork is None or t >= fork), others, fork)  # noqa: B023
    return out


@pytest.mark.parametrize("rows", ["table", "made"])
def test_every_conversation_with_a_reply_has_a_rejected_one(spark, rows, tmp_path):
    if rows == "table":
        folder = FOLDER
    else:
        made = [(c, t, "user" if t % 2 == 0 else "assistant", f"{'same' if c < 40 else c} {t}") for c in range(60) for t in range(2 + c % 5)]
        made += made[:30] + [(70, 0, "user", "no reply"), (71, 0, "assistant", "reply only"), (72, 0, "user", "q"), (72, 1, "assistant", "a"),
                 (72, 1, "tool", "b"), (72, 2, None, None), (None, 0, "user", "x"), (73, None, "assistant", "x")]
        folder = str(tmp_path)
        spark.createDataFrame(made, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want, parts = brute_replies(table), {}
    show = lambda t, r, x: (t, f"<|{r or ''}|>\n{x or ''}<|end|>\n")
    for r in preferences.reply_preferences(spark.read.parquet(f"{folder}/conversations.parquet")).collect():
        parts.setdefault(r.pair_id, {}).setdefault(r.part, []).append((r.turn, r.rendered))
        prompt, _, others, _ = want[r.pair_id]
        assert r.paired == bool(others) and r.prefix_turns == len({t for t, *_ in prompt})
        assert r.loss_mask == int(r.part != "prompt" and r.role == "assistant")
        assert (r.conv_id == r.pair_id) == (r.part != "rejected")
    assert set(parts) == set(want) and any("rejected" in p and "prompt" in p for p in parts.values())
    for c, (prompt, chosen, others, fork) in want.items():
        assert sorted(parts[c].get("prompt", [])) == sorted(show(*x) for x in prompt)
        assert sorted(parts[c]["chosen"]) == sorted(show(*x) for x in chosen)
        assert not others or sorted(parts[c]["rejected"]) in [sorted(show(fork, *x) for x in o) for o in others]
        assert others or "rejected" not in parts[c]
    none = spark.read.parquet(f"{folder}/conversations.parquet").limit(0)
    assert preferences.reply_preferences(none).count() == 0


def brute_prefixes(rows):
    """Conversations as {turn: rows}, the pairs at longest prefixes as greedy rounds make them, and those left alone."""
    convs = {}
    for c, t, r, x in {x for x in rows if x[0] is not None and x[1] is not None}:
        convs.setdefault(c, {}).setdefault(t, set()).add((r, x))
    flat = {c: [(t, frozenset(ts[t])) for t in sorted(ts)] for c, ts in convs.items()}

    def common(a, b):
        n = 0
        while n < min(len(flat[a]), len(flat[b])) and flat[a][n] == flat[b][n]:
            n += 1
        return n

    left, pairs = set(flat), {}
    while True:
        at = {}
        for c in left:
            depth = max((common(c, d) for d in left if d != c), default=0)
            if depth:
                at.setdefault(tuple(flat[c][:depth]), []).append(c)
        if not at:
            return convs, flat, common, pairs, left
        for members in at.values():
            members.sort()
            for a, b in zip(members[::2], members[1::2]):
                pairs[a] = b
                left -= {a, b}


@pytest.mark.parametrize("rows", ["table", "made"])
def test_conversations_are_paired_at_their_longest_prefix(spark, rows, tmp_path):
    if rows == "table":
        folder = FOLDER
    else:
        some, folder = random.Random(4), str(tmp_path)
        made = []
        for c in range(150):
            texts_ = [some.choice("ab") if t < 5 else f"{c}" for t in range(some.randint(1, 7))]
            made += [(c, t, "user" if t % 2 == 0 else "assistant", x) for t, x in enumerate(texts_)]
        made += [(200 + c, t, "user" if t % 2 == 0 else "assistant", "common" if t == 0 else f"{c} {t}") for c in range(41) for t in range(3)]
        # 301 shares one turn with 302 and three with 303.
        for c, said in ((301, "pqrs"), (302, "pxyz"), (303, "pqrt"), (304, "k"), (305, "kl")):
            made += [(c, t, "user" if t % 2 == 0 else "assistant", x * 5) for t, x in enumerate(said)]
        made += made[:30] + [(400 + c, t, r, f"own {c} {t}") for c in range(9) for t, r in enumerate(("user", "assistant", "user"))]
        made += [(420, 0, None, None), (421, 0, "user", "no reply at all"), (None, 0, "user", "x"), (422, None, "assistant", "x")]
        spark.createDataFrame(made, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    frame = spark.read.parquet(f"{folder}/conversations.parquet")
    table = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    convs, flat, common, pairs, alone = brute_prefixes(table)
    assert rows == "table" or pairs[301] == 303
    got = {(r.conv_id, r.pair_id): r.side for r in preferences.pair_at_longest_prefix(preferences.clean_turns(frame)).collect()}
    want = {(a, a): 0 for a in pairs} | {(b, a): 1 for a, b in pairs.items()} | {(c, c): 0 for c in alone}
    assert got == want

    parts = {}
    for r in queries.op3_preferences(spark, folder).collect():
        parts.setdefault(r.pair_id, {}).setdefault(r.part, []).append((r.turn, r.rendered, r.conv_id))
        assert r.loss_mask == int(r.part != "prompt" and r.role == "assistant")
    assert set(parts) == set(pairs) | alone
    show = lambda c, keep, as_: sorted((t, f"<|{r or ''}|>\n{x or ''}<|end|>\n", as_) for t, ts in convs[c].items() if keep(t) for r, x in ts)
    replies = brute_replies(table)
    for a, b in pairs.items():
        n = common(a, b)
        fork = min([t for t, _ in flat[a][n:]] + [t for t, _ in flat[b][n:]], default=10**9)
        assert sorted(parts[a].get("prompt", [])) == show(a, lambda t: t < fork, a)  # noqa: B023
        assert sorted(parts[a].get("chosen", [])) == show(a, lambda t: t >= fork, a)  # noqa: B023
        assert sorted(parts[a].get("rejected", [])) == show(b, lambda t: t >= fork, b)  # noqa: B023
    for c in alone:
        prompt, chosen, others, fork = replies[c]
        assert len(parts[c].get("prompt", [])) == len(prompt) and len(parts[c]["chosen"]) == len(chosen)
        given = [(t, x) for t, x, _ in parts[c].get("rejected", [])]
        assert not others or sorted(given) in [sorted((fork, f"<|{r or ''}|>\n{x or ''}<|end|>\n") for r, x in o) for o in others]
        assert all(d != c for *_, d in parts[c].get("rejected", []))
    assert preferences.longest_prefix_preferences(frame.limit(0)).count() == 0


# --- mixing -----------------------------------------------------------------


def test_mixture(spark, documents, awkward):
    for docs in (documents, awkward):
        got = mixing.mix(docs).collect()
        assert len(got) == docs.count() and all(0 <= r.taken <= 3 * r.size for r in got)
        sizes = collections.Counter()
        for r in got:
            sizes[r.source] += r.size
        names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
        weights = {s: 1 + i % 3 for i, s in enumerate(names)}
        total, held = sum(sizes.values()), {}
        while True:  # reshare what is above the cap until nobody is
            rest, open_ = total - sum(held.values()), [s for s in names if s not in held]
            share = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
            above = [s for s in open_ if share[s] > 3 * sizes[s]]
            if not above:
                break
            held |= {s: 3 * sizes[s] for s in above}
        targets = share | held
        taken = collections.Counter()
        for r in got:
            assert r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source]
            taken[r.source] += r.taken
        assert all(abs(taken[s] - targets[s]) <= 0.5 for s in names)
        out = mixing.mixed(docs)
        assert out.columns == docs.columns
        assert out.select(F.sum(mixing.size_of(F.col("text")))).first()[0] == sum(taken.values())
    again = {tuple(r) for r in mixing.mix(documents.repartition(5)).select("doc_id", "taken").collect()}
    assert again == {tuple(r) for r in mixing.mix(documents).select("doc_id", "taken").collect()}
    assert mixing.mix(documents.limit(0)).count() == 0


# --- quality ----------------------------------------------------------------


def test_quality_of_very_long_texts_and_other_languages(spark):
    prose = "ta mere prose of no known words goes along here and no rule of size or list shall stop it "
    rows = [(1, " ".join(f"word{k}" for k in range(1_000_100)), "fi", "x"), (2, " ".join(f"sana{k}" for k in range(60)), "fi", "y"),
            (3, " ".join(f"sana{k}" for k in range(60)), "en", "y"), (4, " ".join(f"sana{k}" for k in range(60)), None, "y"), (5, prose * 2, "EN", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _text string")
    got = {r.doc_id: r for r in quality.assess(docs).drop("text").collect()}
    assert {d: r.kept for d, r in got.items()} == {1: True, 2: True, 3: False, 4: False, 5: got[5].kept}
    assert {r._text for r in got.values()} == {"x", "y", "z"}
    assert {r.doc_id for r in quality.keep_good(docs).select("doc_id").collect()} == {d for d, r in got.items() if r.kept}


def test_quality_on_awkward_rows(awkward):
    got = quality.assess(awkward).collect()
    assert len(got) == len(AWKWARD)
    by = {r.doc_id: r for r in got}
    assert by[1].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[5].n_words == 3200 and by[5].n_repeat_words == 3200 and by[6].word_chars == 5000
    assert quality.keep_good(awkward).columns == awkward.columns and quality.assess(awkward.limit(0)).count() == 0


# --- language model ---------------------------------------------------------


@pytest.mark.parametrize("known", [neural_lm.KNOWN, 2])
def test_neural_scores(spark, documents, awkward, monkeypatch, known):
    monkeypatch.setattr(neural_lm, "KNOWN", known)
    docs = documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    got = neural_lm.score(docs, top=60, shared=8, rounds=1).collect()
    rows = texts(docs)
    tokens = lambda t: t.encode().lower().split() + [b"\n"]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    counts = collections.Counter(w for d, t in rows if not held(d) for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    base = lambda t: sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens(t))
    want = collections.Counter((d, held(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), round(base(t), 3)) for d, t in rows)
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 3)) for r in got) == want
    assert all(r.train_tokens == total and r.score < 0 for r in got)
    assert neural_lm.score(docs.limit(0)).count() == 0


def test_frequent_tokens_never_exceed_their_number(spark):
    counts = spark.createDataFrame([(bytearray(f"w{k}".encode()), 1 + 1000 // (k + 1)) for k in range(500)] + [(bytearray(b"\n"), 1)], "token binary, n long")
    for most in (0, 1, 7, 100, 10_000):
        got = neural_lm.frequent_tokens(counts, most)
        assert got[0] == (b"\n", 1) and len(got) <= most + 1 and [n for _, n in got[1:]] == sorted((n for _, n in got[1:]), reverse=True)
        least = min((n for _, n in got[1:]), default=10**9)
        missed = [r.n for r in counts.collect() if bytes(r.token) not in dict(got)]
        assert all(n < least for n in missed)


def test_network_scores_held_out_texts_better_than_counts(spark):
    """Log10 a token over the held-out texts of sf0.01: the network's context is worth a tenth at least."""
    got = neural_lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out")
    n, base, model = got.select(F.sum("n_tokens"), F.sum("base_score"), F.sum("score")).first()
    assert model / n > base / n + 0.1


def test_network_probabilities_add_up_and_learn():
    rng = np.random.default_rng(0)
    runs = np.tile([1, 2, 3, 4], 4000) * 1
    weights = np.bincount(runs, minlength=6) + 0.1
    weights = weights / weights.sum()
    net = neural_lm.Network.start(weights, 4)
    sums = neural_lm.Network.unpack(np.full(len(net.pack()), 0.1, np.float32), 4)
    at = np.arange(2, len(runs))

    def loss():
        one, two, norm = net.tables()
        chances = np.exp(one[:, None, :] + two[None, :, :] - norm[:, :, None])
        assert np.allclose(chances.sum(2), 1, atol=1e-4)
        return float(np.mean(one[runs[at - 1], runs[at] - 1] + two[runs[at - 2], runs[at] - 1] - norm[runs[at - 1], runs[at - 2]]))

    before, logs = loss(), np.log(weights).astype(np.float32)
    for _ in range(200):
        some = rng.choice(at, 256)
        net.learn(runs[some - 1], runs[some - 2], runs[some], rng.integers(1, 6, 8), logs, sums)
    assert loss() > before + 0.3


# --- near duplicates --------------------------------------------------------


def brute_links(rows):
    sets = {}
    for d, t in rows:
        w = WORD.findall(t)
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    ids, parent, links = list(sets), {d: d for d in sets}, collections.Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (find(d), links[d]) for d in sets}


def test_near_duplicates_in_crowds(spark, documents):
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(2000)]
    pick = lambda n: [random.choice(vocabulary) for _ in range(n)]
    base, passage, rows = pick(120), pick(40), []
    for i in range(150):  # a crowd of near copies
        w = list(base)
        for _ in range(random.randint(1, 3)):
            w[random.randrange(120)] = random.choice(vocabulary)
        rows.append((10_000 + i, " ".join(w)))
    rows += [(11_000 + i, " ".join(pick(90) + passage + pick(60))) for i in range(150)]  # a passage that many share
    rows += [(12_000, None), (12_001, ""), (12_002, "a b"), (12_003, "a b"), (12_004, "a c"), (12_005, " ".join(base)), (12_006, " ".join(base))]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute_links(texts(docs))
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.near_duplicates(docs).collect()}
    assert got == want
    assert {r.doc_id for r in chosen_path.one_of_each(docs).collect()} == {d for d, (c, _) in want.items() if c == d}


def test_near_duplicates_on_awkward_rows(awkward):
    got = chosen_path.near_duplicates(awkward).collect()
    assert len(got) == len(AWKWARD) and {r.n_links for r in got if r.doc_id == 4} == {1}
    assert chosen_path.near_duplicates(awkward.limit(0)).count() == 0


def test_near_copies_without_a_doc_id(spark):
    random.seed(5)
    pick = lambda n: [f"w{random.randrange(2000)}" for _ in range(n)]

    def near(base):
        w = list(base)
        w[random.randrange(len(w))] = random.choice(["other", "words"])
        return " ".join(w)

    few, many = pick(120), pick(120)
    rows = [(10**6, near(few)), (1, " ".join(few)), (10**6 + 1, near(many))] + [(100 + i, near(many)) for i in range(150)]
    want = brute_links(rows)
    docs = spark.createDataFrame([(d if d < 10**6 else None, t) for d, t in rows], "doc_id long, text string")
    got = chosen_path.near_duplicates(docs).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got if r.doc_id is not None} == {d: w for d, w in want.items() if d < 10**6}
    unnamed = sorted((r.class_id is None, r.n_links) for r in got if r.doc_id is None)
    assert unnamed == sorted((True, want[d][1]) for d in (10**6, 10**6 + 1)) and unnamed[0][1] == 1
    assert sum(r.doc_id is None for r in chosen_path.one_of_each(docs).collect()) == 2


# --- licences ---------------------------------------------------------------


def test_licences(spark, documents, awkward):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    rows = [(70, "MIT license. mit License, the general public license MIT license"), (71, mit), (72, "license " * 3000 + "mit license"),
            (73, licences.TEMPLATES[1].text.replace("copy", "Copy"))]
    docs = documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text")).unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licences.scan(docs).collect())
    want = collections.Counter()
    for d, t in texts(docs):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        places = [(i, label) for phrase, label in licences.BASE.items() for p in [phrase.split()] for i in range(len(ws)) if ws[i : i + len(p)] == p]
        starts = [i for i, _ in places]
        want[(d, len(ws), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))] += 1
    assert got == want
    found = {r.doc_id: r for r in licences.scan(docs).filter("doc_id >= 70").collect()}
    assert found[73].labels == "mit" and found[73].score == 1.0 and found[71].labels == "" and found[72].labels == "mit"
    assert licences.scan(docs.limit(0)).count() == 0


def test_licences_in_texts_with_many_template_words(spark):
    notices = [t.text for t in licences.TEMPLATES]
    every = " ".join(sorted({w for n in notices for w in n.split()}))
    rows = [(1, " xx ".join(notices)), (2, " xx ".join(n for t, n in zip(licences.TEMPLATES, notices) if t.label in ("mit", "apache", "bsd")))]
    rows += [(10 + i, f"{every} xx {n} xx {every}") for i, n in enumerate(notices)]
    rows += [(30 + i, f"{notices[1]} xx {n}") for i, n in enumerate(notices)]
    rows += [(100 + i, "nothing to see") for i in range(200)]
    altered = notices[1].split()
    for i in range(0, len(altered) // 4):  # as many as may be lacking, those of no phrase
        altered[7 + i if 7 + i < 22 else 25 + i] = "other"
    rows.append((50, " ".join(altered)))
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}

    def brute(text):
        ws, out = text.split(), set()
        for t in licences.TEMPLATES:
            n = t.text.split()
            for s in range(1 - len(n), len(ws)):
                piece = ws[max(s, 0) : s + len(n)]
                same = sum(0 <= s + i < len(ws) and ws[s + i] == w for i, w in enumerate(n))
                if same / len(n) >= 0.75 and all(f" {p} " in f" {' '.join(piece)} " for p in t.phrases):
                    out.add((t.label, s, same / len(n)))
        return out

    for d, text in rows:
        assert {(p.label, p.start, p.share) for p in got[d].places} == brute(text), d
    assert len(got[1].places) >= len(notices)


# --- top-k ------------------------------------------------------------------


def test_top_k_against_all(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(0, 0.3, 6).tolist()) for i in range(700)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)]  # many alike
    rows += [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 6), (None, [1.0]), (2150, [0.25]), (7, [0.1] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = frame.select("vec_id", block_topk.quantise(F.col("embedding")).alias("vector"))
    got = collections.Counter(map(tuple, block_topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5, shard=200, queries=5).collect()))
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = collections.Counter()
    for q, v in good:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:5]
            want.update((q, n, i, -s) for n, (s, i) in enumerate(best, 1))
    assert got == want
    assert block_topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# --- repeats ----------------------------------------------------------------


def brute_repeats(rows):
    data = [(d, t.encode()) for d, t in rows]
    seen = collections.Counter(t[i : i + 200] for _, t in data for i in range(len(t) - 199))
    out = collections.Counter()
    for d, t in data:
        mask = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                mask[i : i + 200] = b"\1" * 200
        left = bytes(c for c, m in zip(t, mask) if not m)
        spans = sum(m and not (i and mask[i - 1]) for i, m in enumerate(mask))
        out[d, len(t), sum(mask), spans, hashlib.sha256(left).hexdigest()] += 1
    return out


@pytest.mark.parametrize("crowd", [2048, 5])
def test_repeats(spark, awkward, monkeypatch, crowd):
    monkeypatch.setattr(bwt_repeats, "CROWD", crowd)
    random.seed(2)
    noise = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    passage = noise(900)
    rows = [(11, noise(500) + passage[:300] + noise(50)), (12, noise(20) + passage + noise(300)), (13, passage), (14, passage), (15, "a" * 1000),
            (16, "ab" * 150), (17, "x" * 199), (18, "é" * 150), (19, "é" * 150), (20, "same" * 60), (20, "same" * 60), (21, noise(1000))]
    rows += [(100 + i, noise(250) + passage[100:400] + noise(30)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(awkward.select("doc_id", "text"))
    got = collections.Counter(map(tuple, bwt_repeats.without_repeats(docs).drop("kept").collect()))
    assert got == brute_repeats(texts(docs))
    assert bwt_repeats.without_repeats(docs.limit(0)).count() == 0


@pytest.fixture
def merging(monkeypatch):
    """The tables that the operator writes before it merges, and whether it cut crowds by further keys."""
    written, write = {}, bwt_repeats.materialise

    def watched(df, name):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(bwt_repeats, "materialise", watched)
    return written


@pytest.mark.parametrize("few", [0, 10**9])
def test_repeats_in_crowds_stay_in_small_groups(spark, monkeypatch, merging, few):
    monkeypatch.setattr(bwt_repeats, "CROWD", 5)
    monkeypatch.setattr(bwt_repeats, "FEW", few, raising=False)
    random.seed(4)
    noise = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    passage = noise(400)
    rows = [(i, noise(120) + passage + noise(120)) for i in range(3000)] + [(9000, "a" * 3000), (9001, passage), (9001, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = collections.Counter(map(tuple, bwt_repeats.without_repeats(docs).drop("kept").collect()))
    assert got == brute_repeats(texts(docs))
    assert (merging["merging"].groupBy("key").count().agg(F.max("count")).first()[0] or 0) <= 5
    assert ("further" in merging) == (few == 0)


def test_a_long_periodic_text_is_not_merged_in_one_group(spark, monkeypatch, merging):
    monkeypatch.setattr(bwt_repeats, "BUCKET", 2000)
    docs = spark.createDataFrame([(1, "ab" * 20_000), (2, "x" * 300 + "ab" * 200), (3, "c" * 5000)], "doc_id long, text string")
    got = collections.Counter(map(tuple, bwt_repeats.without_repeats(docs).drop("kept").collect()))
    assert got == brute_repeats(texts(docs))
    sizes = merging["merging"].groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("n"))
    assert (sizes.agg(F.max("n")).first()[0] or 0) <= 2000
