"""The corpus pipeline: documents through five operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import bpe, jaccard, linededup, mixing, quality
from lexloom.llm.common import read_table, stored
from lexloom.llm.queries import VOCABULARY


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules on repetition keep."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(F.struct(*columns).alias("_row"), F.col("text"))
    return quality.judge_quality(marked).filter("kept").select("_row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those that lose all their lines go."""
    cut = linededup.dedup_lines(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text"))
    cut = cut.filter("size(deleted) = 0 or text <> ''")

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        own = F.col("_row").getField(name)
        if name == "n_chars":
            kind = docs.schema[name].dataType
            own = F.when(F.size("deleted") > 0, F.length("text").cast(kind)).otherwise(own)
        return own.alias(name)

    return cut.select(*[column(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares at least 80 % of its five-word shingles."""
    return jaccard.keep_one(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies and passages of documents, so that sources come in their target shares."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts."""
    coded = bpe.encode_texts(docs.select("doc_id", "lang", "source", "text"), VOCABULARY)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode),
]

#: The last stage needs a tokenizer's vocabulary, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``STAGES`` applied to ``documents``; every stage reads what its predecessor has written."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
