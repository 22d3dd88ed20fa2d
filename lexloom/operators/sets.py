"""Merging corpora."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_corpora(**corpora: DataFrame) -> DataFrame:
    """Append corpora in the given order, duplicates kept.

    ``source`` names the corpus and ``source_rank`` its place, so (source_rank, line keys) is the
    line order of the merged corpus.
    """
    tagged = [
        df.select(F.lit(rank).alias("source_rank"), F.lit(name).alias("source"), *df.columns)
        for rank, (name, df) in enumerate(corpora.items())
    ]
    return reduce(lambda a, b: a.unionByName(b), tagged)
