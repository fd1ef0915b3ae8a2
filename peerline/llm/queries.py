"""One query per operator over the synthetic tables, and SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerline.llm import block_topk, bwt_repeats, chosen_path, dialogue, licences, merkle, mixing, neural_lm, pieces, pii, preferences, quality, wrappers
from peerline.llm.common import table

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
NEIGHBOURS = 5


def op1_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its personal data pseudonymised, and how much of each kind there was."""
    return pii.pseudonymise(table(spark, folder, "documents").select("doc_id", "text"))


def op2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    coded = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), MODEL)
    return coded.select("doc_id", "n_tokens", "decoded_ok", "ids")


def op3_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation against one that shares its longest turn prefix, or against itself with another reply: prompt once, completions with masks."""
    return preferences.longest_prefix_preferences(table(spark, folder, "conversations"))


def op4_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken")
    )


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict for every document."""
    judged = quality.assess(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_neural_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base score and model score of every document."""
    return neural_lm.score(table(spark, folder, "documents"))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Class and links of every document."""
    return chosen_path.near_duplicates(table(spark, folder, "documents"))


def op8_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Base phrases and licences of every document."""
    return licences.scan(table(spark, folder, "documents")).drop("places")


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five best neighbours of every fiftieth vector."""
    vectors = table(spark, folder, "embeddings").select("vec_id", block_topk.quantise(F.col("embedding")).alias("vector"))
    return block_topk.top_k(vectors, F.col("vec_id") % 50 == 0, NEIGHBOURS)


def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of every document without its repeated 200-byte strings."""
    return bwt_repeats.without_repeats(table(spark, folder, "documents")).drop("kept")


def op11_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return wrappers.extract(table(spark, folder, "pages"))


def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, folded anew from a text that a third of them had changed."""
    proved = merkle.lower_case_third(table(spark, folder, "documents"))
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation after damage."""
    return dialogue.repair(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pseudonyms, op2_pieces, op3_preferences, op4_mixture, op5_quality,
        op6_neural_scores, op7_near_duplicates, op8_licences, op9_neighbours, op10_repeats, op11_main_text, op12_manifest, op13_repair,
    )
}

# The symbols and stop words the rules speak of, stated anew for the SQL.
SYMBOLS = "#*$%&|<>"
STOPS = ", ".join(
    f"'{w}'"
    for w in (
        "a an and are as at auf au avec be by ce como con das dans de del dem den der des die du ein eine el elle en es est et for from"
        " il in is ist it la las le les los mit ne nicht no not o of on or para pas por pour que qui se sich sie su sur sus that the this to"
        " un una und une von was were with y zu"
    ).split()
)

ORACLE = {
    "op5_quality": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT r, doc_id, lang, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM docs),
places AS (
  SELECT r, i, list_aggregate(w[i:i+7], 'string_agg', ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM parts WHERE len(w) >= 8)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM places) WHERE c > 1),
covered AS (
  SELECT r, sum(least(8, n)) AS c
  FROM (SELECT r, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), 8) AS n FROM again) GROUP BY r),
m AS (
  SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    length(t) - length(replace(t, '!', '')) AS n_shouts,
    len(list_filter(w, lambda x: lower(trim(x, '.,;:!?')) IN ({STOPS}))) AS n_stop_words,
    len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c, 0) AS BIGINT) AS n_repeat_words
  FROM parts LEFT JOIN covered USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    word_chars < 2.0 * n_words OR word_chars > 12.0 * n_words OR n_symbols > 0.1 * n_words
    OR n_shouts > 0.2 * n_words OR (n_words >= 40 AND n_stop_words < 0.04 * n_words AND coalesce(lower(lang) IN ('en', 'fr', 'es', 'de'), true)) OR n_dup_lines > 0.4 * n_lines
  ) AS kept
FROM b""",
    "op9_neighbours": f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {NEIGHBOURS}""",
}
