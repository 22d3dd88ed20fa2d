"""Global order without a single-task window: range sort, per-partition totals, offsets.

Each helper sorts by range, writes the sorted rows to the shared folder so that the partition
boundaries can never move again, and then needs only one tiny row per partition to turn local
positions into global ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import unnest
from ..functions.hashing import hash32
from ..session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_ordinal(df: DataFrame, order: Sequence, out: str = "ordinal") -> DataFrame:
    """Number all rows 0, 1, 2, ... in the order of ``order`` (its values must be unique)."""
    order = [_col(c) for c in order]
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = cut_lineage(sorted_rows.withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", _LOCAL_BITS)
    # One row per partition, so this window stays small whatever the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        marked.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        marked.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + local)
        .drop("_part", "_mid", "_start")
    )


def running_total(
    df: DataFrame, order: Sequence[str], value: str, out: str, group: Sequence[str] = ()
) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the group, in the order of ``order``.

    A group may span many range partitions: each task sums its own slice, and the totals of the
    slices before it are added afterwards, so one huge group never lands in one task.
    """
    group, order = list(group), list(order)
    ranged = cut_lineage(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    slice_keys = ["_part", *group]
    earlier = (Window.unboundedPreceding, -1)
    local = Window.partitionBy(*slice_keys).orderBy(*order).rowsBetween(*earlier)
    slices = Window.partitionBy(*group).orderBy("_part").rowsBetween(*earlier)
    starts = (
        ranged.groupBy(*slice_keys)
        .agg(F.sum(value).alias("_sum"))
        .select(*slice_keys, F.coalesce(F.sum("_sum").over(slices), F.lit(0)).alias("_start"))
    )
    return (
        ranged.withColumn("_local", F.coalesce(F.sum(value).over(local), F.lit(0)))
        .join(starts, slice_keys)
        .withColumn(out, F.col("_start") + F.col("_local"))
        .drop("_part", "_start", "_local")
    )


def shard_lines(df: DataFrame, n: int, order: Sequence[str] = ("doc_id", "line_no")) -> DataFrame:
    """Shards of ``n`` consecutive lines: adds ``ordinal`` and ``shard``."""
    return with_ordinal(df, order).withColumn("shard", F.floor(F.col("ordinal") / n).cast("bigint"))


def shard_documents(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``shard_lines`` for lines that still sit in their documents.

    Only (key, line count) is sorted; the text moves once, in the join with the offsets.
    """
    counts = docs.select(key, F.size(F.split(F.col(text), "\n")).cast("bigint").alias("_n"))
    starts = running_total(counts, [key], "_n", "_first").drop("_n")
    ordinal = F.col("_first") + F.col("line_no")
    joined = docs.select(key, text).join(starts, key)
    return (
        unnest(joined, [key, "_first"], F.split(F.col(text), "\n"), "line", "line_no")
        .withColumn("ordinal", ordinal)
        .withColumn("shard", F.floor(ordinal / n).cast("bigint"))
        .drop("_first")
    )


def shuffle_records(df: DataFrame, keys: Sequence[str], seed: int = 7) -> DataFrame:
    """Reproducible shuffle: ``ordinal`` is the row's place in the order of its hashed keys."""
    shuffled = df.withColumn("_key", hash32(seed, *[F.col(k) for k in keys]))
    return with_ordinal(shuffled, ["_key", *keys]).drop("_key")
