"""What several operators share: tables in the shared folder, safe column names, global positions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder

LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/lexloom-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Later steps read it with column pruning, do not recompute it, survive lost executors, and Spark
    knows its size when it chooses a join. All tables of one application lie in one folder,
    ``lexloom-<application id>`` below ``spark.checkpoint.dir``, which may go when it has ended.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text) -> str:
    """SQL for the number of words (runs without ASCII white space) of a text; 0 for NULL."""
    return f"coalesce(regexp_count({text}, '[^\\\\x20\\\\x09-\\\\x0D]+'), 0)"


def seeded(seed: int, *parts: str) -> Column:
    """60 bits of md5 over the seed and the parts joined by ``|`` (NULLs are left out), as BIGINT."""
    cols = [F.lit(str(seed)), *[F.col(p).cast("string") for p in parts]]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 15), 16, 10).cast("bigint")


def positions(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str,
    value: str | None = None,
    out: str = "slot",
    facts: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: the number of earlier rows of the group (or the sum of their ``value``).

    Rows are sorted by range, so a group of any size spans many tasks; each task counts its own
    slice, and one small row per slice carries the totals on. ``facts``, a row per group, reaches
    the rows by way of these slices, so that no hot group meets in a join. ``group`` columns hold
    no NULL.
    """
    group, order = list(group), list(order)
    keys = ["_part", *group]
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    ranged = stored(ranged.withColumn("_mid", F.monotonically_increasing_id()), name)
    ranged = ranged.withColumn("_part", F.shiftright("_mid", LOCAL_BITS))
    earlier = (Window.unboundedPreceding, -1)
    slices = Window.partitionBy(*group).orderBy("_part").rowsBetween(*earlier)
    total = F.count("*") if value is None else F.sum(value)
    starts = (
        ranged.groupBy(*keys)
        .agg(total.alias("_sum"), F.min("_mid").alias("_low"))
        .select(*keys, "_low", F.coalesce(F.sum("_sum").over(slices), F.lit(0)).alias("_start"))
    )
    if facts is not None:
        starts = starts.join(facts, group)
    if value is None:
        local = F.col("_mid") - F.col("_low")
    else:
        local = F.coalesce(
            F.sum(value).over(Window.partitionBy(*keys).orderBy("_mid").rowsBetween(*earlier)), F.lit(0)
        )
        ranged = ranged.withColumn("_local", local)
        local = F.col("_local")
    return (
        ranged.join(starts, keys)
        .withColumn(out, F.col("_start") + local)
        .drop("_part", "_mid", "_start", "_low", "_local")
    )
