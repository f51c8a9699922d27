"""The corpus pipeline: identify languages, filter by quality, drop near copies, hide personal
data, pack. Each stage reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import language, packing, pseudonyms, quality, simhash
from reviewlens.llm.common import held_out, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document of label 1 scores near 1; below this one it is rejected.
QUALITY = 0.7
#: Shingle length and bit distance of the SimHash stage, as its operator's contract has them.
SIMHASH_SHINGLE = 3
SIMHASH_RADIUS = 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is identified."""
    known = language.profiles(docs.where(~held_out("doc_id")))
    return language.identify(docs, known, COLUMNS).where(F.col("lang_pred") != language.UNKNOWN).select(*COLUMNS)


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose neighbours vote for quality."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    scored = quality.score(docs, quality.fit(docs, labels), COLUMNS)
    return scored.where(F.col("score") >= QUALITY).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies, and one row of it.

    Near copies have fingerprints of three-word shingles that differ in at most two bits. Documents
    without an id stay, since no other can be told to stand for them.
    """
    groups = simhash.grouped(docs.select("doc_id", "text"), SIMHASH_RADIUS, SIMHASH_SHINGLE)
    copies = groups.where("doc_id <> component_id").select("doc_id").distinct()
    rest = docs.select(*COLUMNS).join(copies, "doc_id", "left_anti")
    return rest.dropDuplicates(["doc_id", "text"])


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms of the same format, made with the session's key."""
    key = pseudonyms.session_key(spark)
    return pseudonyms.pseudonymized(docs.select(*COLUMNS), key).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of all documents into windows."""
    return packing.packed(docs)


STAGES = [
    ("language", identify_language),
    ("quality", filter_quality),
    ("near_copies", drop_near_copies),
    ("personal_data", hide_personal_data),
    ("packing", pack),
]

#: No SQL for any of the stages; tests/llm compare with a plain reading of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
