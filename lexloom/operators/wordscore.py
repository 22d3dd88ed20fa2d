"""Word scores from prefix statistics: forward cohesion and right branching entropy.

Our rule: words are prefixes of 1 to ``longest`` characters of white-space tokens; prefixes one
character longer are counted too, as the extensions the entropy is taken over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import unnest
from ..session import cut_lineage
from .vocab import token_counts


def prefix_counts(df: DataFrame, longest: int = 10, col: str = "tokens") -> DataFrame:
    """(word, freq) of all token prefixes of up to ``longest`` + 1 characters.

    Tokens are counted first, so prefixes are made once per distinct token.
    """
    ends = F.sequence(F.lit(1), F.least(F.length("word"), F.lit(longest + 1)))
    prefixes = unnest(token_counts(df, col).filter("word <> ''"), ["word", "cnt"], ends, "_end")
    return (
        prefixes.select(F.substring(F.col("word"), F.lit(1), F.col("_end")).alias("word"), "cnt")
        .groupBy("word")
        .agg(F.sum("cnt").alias("freq"))
    )


def cohesion_forward(prefixes: DataFrame) -> DataFrame:
    """(word, freq, cohesion_forward): (f(word) / f(first character)) ^ (1 / (n - 1)); 0 for n = 1."""
    # At most one row per Unicode character, so this side is always small enough to broadcast.
    firsts = prefixes.filter(F.length("word") == 1).select(
        F.col("word").alias("_first"), F.col("freq").alias("_freq")
    )
    n = F.length("word")
    ratio = F.col("freq") / F.col("_freq")
    cohesion = F.when(n == 1, F.lit(0.0)).otherwise(F.pow(ratio, 1.0 / (n - 1)))
    return (
        prefixes.withColumn("_first", F.substring("word", 1, 1))
        .join(F.broadcast(firsts), "_first")
        .select("word", "freq", cohesion.alias("cohesion_forward"))
    )


def right_branching_entropy(prefixes: DataFrame) -> DataFrame:
    """(word, right_branching_entropy) of every prefix that has extensions."""
    parent = F.expr("substring(word, 1, length(word) - 1)")
    total, weighted = F.sum("freq"), F.sum(F.col("freq") * F.ln("freq"))
    return (
        prefixes.filter(F.length("word") > 1)
        .groupBy(parent.alias("word"))
        .agg((F.ln(total) - weighted / total).alias("_entropy"))
        .select("word", F.greatest("_entropy", F.lit(0.0)).alias("right_branching_entropy"))
    )


def word_scores(
    df: DataFrame,
    min_frequency: int = 100,
    min_cohesion: float = 0.05,
    min_entropy: float = 0.0,
    longest: int = 10,
    col: str = "tokens",
) -> DataFrame:
    """(word, freq, cohesion_forward, right_branching_entropy, score) above the three minima."""
    # Read three times below; filters on the word's length would otherwise reach the corpus scan
    # and make each of the three count it again.
    prefixes = cut_lineage(prefix_counts(df, longest, col))
    return scores_from_prefixes(prefixes, min_frequency, min_cohesion, min_entropy, longest)


def scores_from_prefixes(
    prefixes: DataFrame,
    min_frequency: int = 100,
    min_cohesion: float = 0.05,
    min_entropy: float = 0.0,
    longest: int = 10,
) -> DataFrame:
    # Few words pass the minimum frequency: filter before the join, extensions stay unfiltered.
    cohesion = cohesion_forward(prefixes).filter(
        (F.col("freq") >= min_frequency)
        & (F.length("word") <= longest)
        & (F.col("cohesion_forward") >= min_cohesion)
    )
    entropy = F.coalesce("right_branching_entropy", F.lit(0.0))
    return (
        cohesion.join(right_branching_entropy(prefixes), "word", "left")
        .withColumn("right_branching_entropy", entropy)
        .filter(F.col("right_branching_entropy") >= min_entropy)
        .withColumn("score", F.col("cohesion_forward") * F.exp("right_branching_entropy"))
    )
