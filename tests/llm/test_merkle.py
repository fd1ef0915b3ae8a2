"""The manifest against a brute-force tree."""

import collections
import hashlib
import zlib

import pytest

from peerline.llm import merkle, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, key string, idx long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Root and, for each node, its runs as (left, right) from the bottom up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for path, i in zip(paths, at):
            run = runs[i // 8]
            path.append(("".join(run[: i % 8]), "".join(run[i % 8 + 1 :])))
        at = [i // 8 for i in at]
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def brute(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    if not rows:
        return collections.Counter()
    trees = collections.defaultdict(list)
    for r in rows:
        trees[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {lang: climb([x[2] for x in sorted(trees[lang], key=lambda x: x[:3])]) for lang in order}
    root, over = climb([built[lang][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for (_, _, own, r), path in zip(sorted(trees[lang], key=lambda x: x[:3]), built[lang][1]):
            path, node = path + over[k], own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in path:
                node = h(left, node, right)
            out.append((r[0], own, built[lang][0], root, h(*(a + b for a, b in path)), node, node == root))
    return collections.Counter(out)


def got(df):
    return collections.Counter(tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_documents_agree_with_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    want = brute([tuple(r) for r in docs.collect()])
    assert got(queries.op12_manifest(spark, FOLDER)) == want
    assert {verified for *_, verified in want} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 8, 9, 65, 520])
def test_any_number_of_leaves(spark, n):
    rows = [(i * 7 % 1009, "s", "en", i, f"Text {i}", "x", "y", 1) for i in range(n)]
    assert got(merkle.lower_case_third(spark.createDataFrame(rows, SCHEMA))) == brute([r[:5] for r in rows])


def test_awkward_rows(spark):
    rows = [
        (None, None, None, None, None), (None, "s", "en", 3, "Abc"), (3, "", "", 0, ""), (4, "s", "en", 3, "Déjà Vu"),
        (4, "s", "en", 3, "Déjà Vu"), (4, "s", "en", 3, "Other"), (5, "s", "EN", None, "Z" * 3_000_000), (6, "s", "é", 1, "-"),
        *((7, "s", "en", 9, "Copies") for _ in range(30)), *((i, "s", f"l{i}", 1, "Many Trees") for i in range(100, 170)),
    ]
    df = spark.createDataFrame([(*r, "clash", "clash", 5) for r in rows], SCHEMA)
    assert got(merkle.lower_case_third(df)) == brute(rows)


def test_path_proves_other_fields_too(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"t{i}", "", "", 0) for i in range(20)], SCHEMA)
    rows = merkle.manifest(docs, fields=("doc_id", "text")).collect()
    assert all(r.verified and r.leaf == leaf((r.doc_id, f"t{r.doc_id}")) and len(r.path) == 2 for r in rows)
