"""Exploding computed arrays.

A plain ``explode`` makes the optimizer add a filter on the array's size, which computes the array
a second time below the projection that made it. The outer form has no such filter; the rows it
adds for empty arrays are dropped right after.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, keep, array, out: str, pos: str | None = None) -> DataFrame:
    """``keep`` columns plus one row per non-null element of ``array`` (and its position)."""
    column = F.col(array) if isinstance(array, str) else array
    made: Column = F.explode_outer(column).alias(out) if pos is None else F.posexplode_outer(column).alias(pos, out)
    return df.select(*keep, made).filter(F.col(out).isNotNull())


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once a row, however many elements of an array ``then`` goes over."""
    return F.get(F.transform(F.array(value), then), F.lit(0))
