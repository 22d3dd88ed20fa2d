"""Writers of line corpora, vocabularies, vectors and model tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import format_labelled
from ..session import stored


def _line(df: DataFrame, col: str) -> Column:
    is_array = df.schema[col].dataType.typeName() == "array"
    return F.array_join(col, " ") if is_array else F.col(col)


def write_lines(df: DataFrame, path: str, order: Sequence[str] = ("doc_id", "line_no"), col: str = "line") -> None:
    """A line corpus in key order across and inside the part files; tokens are space-joined.

    The lines are stored first: sorting by range looks at its input twice, and would make them twice.
    """
    made = stored(df.select(*order, _line(df, col).alias("_value")))
    ranged = made.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select(F.col("_value").alias("value")).write.mode("overwrite").text(path)


def write_labelled_lines(
    df: DataFrame, path: str, order: Sequence[str] = ("doc_id", "line_no"), col: str = "line", label: str = "label"
) -> None:
    """``text␞label`` lines in key order."""
    joined = format_labelled(df.withColumn(col, _line(df, col)), col, label)
    write_lines(joined, path, order, col)


def write_vocab(df: DataFrame, path: str, token: str = "token") -> None:
    """``id<TAB>token`` lines in id order; a vocabulary is bounded by its wanted size."""
    rows = df.repartitionByRange("id").sortWithinPartitions("id")
    rows.select(F.concat_ws("\t", F.col("id").cast("string"), F.col(token)).alias("value")).write.mode("overwrite").text(path)


def write_token_list(df: DataFrame, path: str, token: str = "token") -> None:
    """One token per line in id order, the line number being the id."""
    write_lines(df, path, ["id"], token)


def write_vectors(df: DataFrame, path: str) -> None:
    """``word v1 ... vn`` lines."""
    numbers = F.array_join(F.transform("vec", lambda v: v.cast("string")), " ")
    df.select(F.concat_ws(" ", "word", numbers).alias("value")).write.mode("overwrite").text(path)


def write_shards(df: DataFrame, path: str, col: str = "line") -> None:
    """One folder per shard (columns ``shard``, ``ordinal``), its lines in order.

    Rows are range-partitioned by ordinal, so a shard is written by the task or few tasks that hold it.
    """
    ranged = df.repartitionByRange("ordinal").sortWithinPartitions("ordinal")
    ranged.select("shard", _line(df, col).alias("value")).write.mode("overwrite").partitionBy("shard").text(path)


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
