"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, jaccard, language, linededup, mixing, pii, quality, secrets, sharding, spelling, tokenfile, topk
from .common import new_folder, read_table
from .oracles import ORACLES

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(read_table(spark, sf_dir, "documents")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text", "line_chars", "dup_line_chars", "ngram_chars")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source", "source_size", "target", "taken")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    tokenfile.write_tokens(read_table(spark, sf_dir, "documents"), folder, VOCABULARY, END_ID)
    return tokenfile.read_documents(tokenfile.open_shards(spark, folder))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(read_table(spark, sf_dir, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_records(read_table(spark, sf_dir, "documents"), [1.0] * 40, [1.0] * 41)


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = linededup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    bounds = F.array_join(F.col("deleted").cast("array<string>"), ",").alias("deleted")
    return cut.select("doc_id", "n_lines", bounds, F.sha2("text", 256).alias("kept_sha256"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(read_table(spark, sf_dir, "documents")))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_texts(docs, VOCABULARY, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.group_variants(read_table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = language.identify(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return named.select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_quality": op2_quality,
    "op3_mix": op3_mix,
    "op4_topk": op4_topk,
    "op5_tokens": op5_tokens,
    "op6_jaccard": op6_jaccard,
    "op7_shard": op7_shard,
    "op8_lines": op8_lines,
    "op9_pii": op9_pii,
    "op10_bpe": op10_bpe,
    "op11_spelling": op11_spelling,
    "op12_audit": op12_audit,
    "op13_language": op13_language,
}

__all__ = ["ORACLES", "QUERIES"]
