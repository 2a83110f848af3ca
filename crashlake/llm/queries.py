"""The registered queries of the numbered operators: thin digests of their results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake.llm import op1_simhash, op2_topk, op3_langid, op4_lm_score, op5_packing, op6_url_filter, op7_rules, op8_mixing, op9_sharding, op10_quality, op11_sentencepiece, op12_merkle, op13_collocations
from crashlake.llm.common import held_out, table
from crashlake.llm.oracle import ORACLE  # noqa: F401


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op1_simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = op2_topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return op2_topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = op3_langid.train(docs.where(~held_out(F.col("doc_id"))))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), op3_langid.language(F.col("text"), model, spark).alias("x"))
    return found.select("doc_id", "held_out", F.col("x.lang").alias("lang_pred"), F.col("x.score").alias("score"), F.col("x.ambiguous").alias("ambiguous"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return op4_lm_score.score(table(spark, sf_dir, "documents"), good)


def op5_packing_ffd(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = op5_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = op6_url_filter.judge(table(spark, sf_dir, "pages"))
    return judged.select(F.col("doc.page_id").alias("page_id"), "host", "path", "rule", "verdict", "trust", "distrust")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = op7_rules.with_statistics(docs).withColumn("doc_id", F.col("doc.doc_id")).drop("doc")
    return op7_rules.judge(rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("d2", 6).alias("distance2"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = op8_mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = op9_sharding.shard_by_bytes(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = op10_quality.train(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), op10_quality.quality(F.col("text"), model, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op11_sentencepiece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", op11_sentencepiece.encode_decode(F.col("text"), public_tokenizers.path("piece_bpe_32k.model"), spark).alias("x"))
    ids = F.array_join(F.col("x.ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("x.ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("x.text", 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = {"text": op12_merkle.tampered_text(F.col("doc_id"), F.col("text"))}
    return op12_merkle.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], changed=changed)


def op13_collocations_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_exact_topk": op2_exact_topk,
    "op3_language_id": op3_language_id,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_packing_ffd": op5_packing_ffd,
    "op6_url_filters": op6_url_filters,
    "op7_quality_rules": op7_quality_rules,
    "op8_source_mixing": op8_source_mixing,
    "op9_byte_shards": op9_byte_shards,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_sentencepiece_bpe": op11_sentencepiece_bpe,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_collocations": op13_collocations_mining,
}

