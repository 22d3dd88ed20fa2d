"""Word counts, vocabularies and character coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import unnest
from .order import with_ordinal


def token_counts(df: DataFrame, col: str = "tokens") -> DataFrame:
    """(word, cnt) of every distinct token; counts combine before the shuffle."""
    return unnest(df, [], col, "word").groupBy("word").agg(F.count("*").alias("cnt"))


def vocab_count(df: DataFrame, min_count: int = 5, col: str = "tokens") -> DataFrame:
    """Words seen at least ``min_count`` times, most frequent first, ties by word."""
    counts = token_counts(df, col).filter(F.col("cnt") >= min_count)
    return counts.orderBy(F.desc("cnt"), "word")


def word_ids(vocab: DataFrame, first: int = 0) -> DataFrame:
    """(id, word, cnt) with ids in vocabulary order, starting at ``first``."""
    return with_ordinal(vocab, [F.desc("cnt"), "word"], "id").withColumn("id", F.col("id") + first)


# Sentence and unknown markers that open a language-model vocabulary.
LM_MARKERS = ("<S>", "</S>", "<UNK>")


def lm_vocab(df: DataFrame, col: str = "tokens", markers: Sequence[str] = LM_MARKERS) -> DataFrame:
    """Vocabulary of a language model: markers first, then all words by frequency."""
    spark = df.sparkSession
    head = spark.createDataFrame([(i, m) for i, m in enumerate(markers)], "id bigint, token string")
    words = token_counts(df, col).filter(~F.col("word").isin(*markers))
    body = word_ids(words, len(markers)).select("id", F.col("word").alias("token"))
    return head.unionByName(body)


def covered_characters(counts: DataFrame, coverage: float) -> DataFrame:
    """The most frequent characters of (ch, cnt) that together reach the wanted share.

    A character is kept when the characters before it do not reach the share yet. There is one row
    per Unicode character at most, so the running sum is small whatever the corpus.
    """
    before = Window.orderBy(F.desc("cnt"), "ch").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("_before", F.coalesce(F.sum("cnt").over(before), F.lit(0)))
        .withColumn("_total", F.sum("cnt").over(Window.partitionBy()))
        .filter(F.col("_before") < F.col("_total") * coverage)
        .select("ch", "cnt")
    )


def char_coverage(df: DataFrame, coverage: float = 0.9995, col: str = "line") -> DataFrame:
    """(ch, cnt) of the alphabet that holds the wanted share of the text, spaces left out."""
    chars = unnest(df, [], F.split(col, ""), "ch").filter(~F.col("ch").isin("", " "))
    return covered_characters(chars.groupBy("ch").agg(F.count("*").alias("cnt")), coverage)
