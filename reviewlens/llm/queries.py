"""The registered queries: each operator over its whole table, reduced to its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from reviewlens.llm import (
    ball_trees,
    byte_pairs,
    caps,
    language,
    limb_codes,
    nearest,
    packing,
    pseudonyms,
    quality,
    simhash,
    token_automaton,
    warc,
    wrappers,
)
from reviewlens.llm.common import held_out, table


def op1_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    fields = F.col("metadata.fields")
    return whole.select(
        F.expr("try_cast(metadata.fields['pageId'] AS BIGINT)").alias("page_id"),
        fields["payloadBytes"].cast("long").alias("payload_bytes"),
        F.substring_index("capture.payload_digest", ":", -1).alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        fields["refersToPage"].cast("long").alias("refers_to"),
    )


def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pseudonyms.pseudonymized(docs, pseudonyms.session_key(spark), spans="spans")
    return found.select("doc_id", "text", F.size("spans").cast("long").alias("n_found"), "spans")


def op4_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    return quality.score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op5_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = caps.grouped(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    read_back = byte_pairs.decode(byte_pairs.encode(table(spark, sf_dir, "documents")))
    return read_back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("content", 256).alias("decoded_sha256"),
    )


def op7_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.search(vectors, F.col("vec_id") % 50 == 0)


def op8_least_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op9_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op10_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.profiles(docs.where(~held_out("doc_id"))))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op11_limb_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = limb_codes.compressed(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


def op12_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_trees.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    read_back = token_automaton.decode(token_automaton.encode(table(spark, sf_dir, "documents")))
    return read_back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_wrapper_text": op1_wrapper_text,
    "op2_warc_transactions": op2_warc_transactions,
    "op3_feistel_pseudonyms": op3_feistel_pseudonyms,
    "op4_neighbour_quality": op4_neighbour_quality,
    "op5_cap_filters": op5_cap_filters,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_multiprobe": op7_multiprobe,
    "op8_least_squares_packing": op8_least_squares_packing,
    "op9_covering_simhash": op9_covering_simhash,
    "op10_hyperdimensional_language": op10_hyperdimensional_language,
    "op11_limb_codes": op11_limb_codes,
    "op12_ball_tree_search": op12_ball_tree_search,
    "op13_token_automaton": op13_token_automaton,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {"op11_limb_codes": limb_codes.SQL, "op12_ball_tree_search": ball_trees.SQL}
