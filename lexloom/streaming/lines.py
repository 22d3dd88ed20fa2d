"""Stateless line operators on a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import unnest
from ..functions.hangul import to_jamo


def stream_documents(spark: SparkSession, path: str, schema) -> DataFrame:
    """Documents as they arrive in a folder of Parquet files."""
    return spark.readStream.schema(schema).parquet(path)


def clean_token_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents to digit-split tokens and letters; the same on batch and streaming frames."""
    lines = unnest(docs, [key], F.split(F.col(text), "\n"), "line", "line_no")
    clean = lines.withColumn("line", tx.collapse_ws(tx.strip_line("line")))
    tokens = clean.withColumn("tokens", tx.split_digits(tx.split_tokens("line")))
    return tokens.withColumn("jamo", to_jamo("line"))
