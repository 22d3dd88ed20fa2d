"""Vector arithmetic on ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import joined, unit_hashes


def dot(a, b) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def random_vector(word, dim: int, seed: int = 7) -> Column:
    """Reproducible start vector of a word, every entry uniform in [-0.5, 0.5)."""
    return F.transform(unit_hashes(joined(seed, word), dim), lambda x: x - 0.5)


def mean_vectors(
    rows: DataFrame, keys: Sequence[str], vec: str = "vec", weight: str = "w", out: str = "vec", dim: int | None = None
) -> DataFrame:
    """Weighted mean vector per key, as ``array<double>``.

    One plain sum per position: these aggregate in fixed-width hash buffers on the map side, where
    an object aggregate would fall back to sorting after a few keys.
    """
    if dim is None:
        first = rows.select(F.size(vec)).first()
        dim = first[0] if first else 0
    w = F.col(weight)
    sums = [F.sum(F.get(vec, F.lit(i)).cast("double") * w).alias(f"_{i}") for i in range(dim)]
    totals = rows.groupBy(*keys).agg(F.sum(w).alias("_w"), *sums)
    mean = F.array(*[F.col(f"_{i}") / F.col("_w") for i in range(dim)]) if dim else F.array().cast("array<double>")
    return totals.select(*keys, mean.alias(out))
