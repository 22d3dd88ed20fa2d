"""Topics of documents by expectation maximization on a grid of documents and words.

The topic-word table lies in blocks of words, the document-topic table in blocks of documents; blocks
meet on the grid that holds the counts, and a task never sees more than one block of each. Both
tables are renewed from the same shares of topics, in one pass over the counts, so a round is one whole
step of EM and the objective never rises. The driver sees one number for each topic.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import unnest
from ..functions.vectors import random_vector
from ..session import cut_lineage, discard, spread, stored
from .grid import Grid, added, sums_of
from .order import with_ordinal

DOC_PRIOR, WORD_PRIOR = 0.1, 0.01  # counts added for every topic of a document and every word of a topic


def _shares(grid: Grid, docs: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((id, vec) of documents and of words, their parts): the expected count under each topic, of documents also,
    last, the negative logarithm of the likelihood of its cells. One pass makes both sides."""

    def fold(mine: np.ndarray, theirs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joint = mine * theirs
        total = joint.sum(axis=1)
        joint *= (times / total)[:, None]
        return np.concatenate([joint, -(times * np.log(total))[:, None]], axis=1), joint

    parts = sums_of(grid, fold, docs, words)
    return cut_lineage(added(grid, parts, "row")), cut_lineage(added(grid, parts, "col")), parts


def _normal(vec: Column, k: int, prior: float) -> Column:
    counts = F.transform(F.slice(vec, 1, k), lambda x: x + prior)
    return F.transform(counts, lambda x: x / F.aggregate(counts, F.lit(0.0), lambda a, b: a + b))


def _log_sum(table: DataFrame, prior: float) -> float:
    return prior * (table.agg(F.sum(F.aggregate("vec", F.lit(0.0), lambda a, x: a + F.ln(x)))).first()[0] or 0.0)


def lda(df: DataFrame, k: int = 10, key: str = "doc_id", col: str = "tokens", iters: int = 20, seed: int = 7) -> tuple[DataFrame, DataFrame, list[float], float]:
    """((key, topics), (word, vec), objectives, perplexity): topic shares of every document and word.

    ``key`` is unique. A word's vec holds its share in each topic. The objective before each round is
    the negative log-likelihood less the priors' logarithms; the perplexity is the last round's.
    Documents without words have equal shares.
    """
    counts = stored(unnest(df, [key], col, "word").groupBy(key, "word").agg(F.count("*").alias("n")))
    docs = cut_lineage(with_ordinal(counts.select(key).distinct(), [key], "i"))
    words = cut_lineage(with_ordinal(counts.select("word").distinct(), ["word"], "j"))
    cells = counts.join(docs, key).join(words, "word").select("i", "j", F.col("n").cast("double").alias("target"), F.lit(1.0).alias("weight"))
    cells = stored(cells)
    row = (2 * k + 1) * 8  # shares and sums
    grid = Grid(cells, row_bytes=row)
    total = cells.agg(F.sum("target")).first()[0] or 1.0
    theta = cut_lineage(docs.select(F.col("i").alias("id"), F.array_repeat(F.lit(1.0 / k), k).alias("vec")))
    start = F.transform(random_vector(F.col("word"), k, seed), lambda v: v + 1.0)
    phi = cut_lineage(_by_topic(spread(words).select(F.col("j").alias("id"), start.alias("vec")), k))
    losses, likelihood = [], 0.0
    for _ in range(iters):
        own, theirs, parts = _shares(grid, theta, phi)
        likelihood = own.agg(F.sum(F.element_at("vec", -1))).first()[0] or 0.0
        losses.append(likelihood - _log_sum(theta, DOC_PRIOR) - _log_sum(phi, WORD_PRIOR))
        last = (own, theirs, parts, theta, phi)
        theta = cut_lineage(own.select("id", _normal(F.col("vec"), k, DOC_PRIOR).alias("vec")))
        phi = cut_lineage(_by_topic(theirs.select("id", F.transform("vec", lambda x: x + WORD_PRIOR).alias("vec")), k))
        for table in last:
            discard(table)  # a round replaces what the one before it has left
    shares = docs.join(theta.withColumnRenamed("id", "i"), "i").select(key, F.col("vec").alias("topics"))
    every = df.select(key).join(shares, key, "left")
    equal = F.array_repeat(F.lit(1.0 / k), k)
    named = words.join(phi.withColumnRenamed("id", "j"), "j").select("word", "vec")
    return every.select(key, F.coalesce("topics", equal).alias("topics")), named, losses, float(np.exp(likelihood / total))


def _by_topic(table: DataFrame, k: int) -> DataFrame:
    """Every topic's column divided by its sum: one number for each topic."""
    sums = table.agg(*[F.sum(F.get("vec", F.lit(t))).alias(f"_{t}") for t in range(k)]).first()
    columns = F.array(*[F.lit(float(s or 1.0)) for s in sums])
    return table.select("id", F.zip_with("vec", columns, lambda x, s: x / s).alias("vec"))
