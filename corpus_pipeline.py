"""A corpus from raw documents to token ids in five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerline.llm import chosen_path, mixing, pieces, pii, quality
from peerline.llm.queries import MODEL
from peerline.session import materialise


def measured(docs: DataFrame) -> DataFrame:
    """n_chars counted anew where a stage may have changed texts."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table, with all their columns.

    A null or empty text has no words and goes; rows alike are judged alike and all stay. Where there is a column `lang`, texts in
    languages without a list of stop words are not held to them. An empty table gives no rows.
    """
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one whose id is the smallest, with all its columns.

    Texts without words, and rows without a doc_id, are copies of nothing and stay; of rows that repeat an id and a text one
    stays. Other columns are carried along, whatever their names.
    """
    return chosen_path.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same format, n_chars counted anew.

    Null texts stay null, rows alike stay alike. Columns named like the operator's counts (`n_email` and so on) hold those counts.
    """
    return measured(pii.pseudonymise(docs).select(*docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights, documents repeated where a source goes round.

    Needs a column `source`; null is a source of its own, the last. A document without words comes as often as its source
    goes round as a whole, which may be never. Rows alike count each on its own. The cut at a source's budget may shorten one
    document, whose n_chars is counted anew.
    """
    return measured(mixing.mixed(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each mixed document; a null text has none, rows alike are coded alike.

    Needs the columns doc_id, source, lang and text; no other column is passed on.
    """
    coded = pieces.encode(docs.select("doc_id", "source", "lang", "text"), MODEL)
    return coded.select("doc_id", "source", "lang", "n_tokens", "decoded_ok", "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("token_ids", token_ids),
]
ORACLE_SQL = None  # hashed shingles, keyed digests and token ids have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
