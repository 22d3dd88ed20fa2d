"""Session defaults, lineage cuts and the size check that guards every broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_CONF = "spark.lexloom.broadcastBytes"
BROADCAST_BYTES = 128 << 20

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str, master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for an unset local session."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lexloom-"))
    return sc.getCheckpointDir()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Frames made meanwhile remove their shuffle files when their action has ended, instead of when the
    driver happens to collect garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared folder: it survives lost executors and is computed once."""
    shared_folder(df.sparkSession)
    with _shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def discard(df: DataFrame) -> None:
    """Delete the files of a table from ``cut_lineage`` that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        path = sc._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: for tables of the corpus' size, whose
    lines and tokens take a fraction of a checkpoint's bytes there. Partitions do not stay as they were."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give an input with fewer splits than cores one partition per core; others stay as read.

    For scans and checkpoints alone: counting the partitions of a plan with shuffles would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_CONF, str(BROADCAST_BYTES)))


def _held_bytes(field: T.StructField) -> Column:
    """About what a value takes in a worker's memory, from its type and length."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(col) + 64
    elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
        size = F.size(col) * 8 + 64
    elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        size = F.octet_length(F.to_json(F.struct(col))) * 4 + 64
    else:
        size = F.lit(32)
    return F.coalesce(size.cast("bigint"), F.lit(16).cast("bigint"))


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes as Python objects, by its types and lengths."""
    return sum((_held_bytes(f) for f in df.schema.fields), F.lit(64).cast("bigint"))


def heaviest(df: DataFrame, count: str, limit: int, size: Column | None = None) -> int:
    """The least count from which on all rows of ``df``, of ``size`` bytes each, are together within ``limit``.

    The driver sees a row for each distinct count, of which n elements have no more than sqrt(2 n).
    """
    size = row_bytes(df) if size is None else size
    sizes = df.groupBy(count).agg(F.sum(size).alias("b")).orderBy(F.desc(count)).toLocalIterator()
    least = None
    for n, held in sizes:
        limit -= held
        if limit < 0:
            return n + 1 if least is None else least
        least = n
    return 0


def measured(df: DataFrame, limit: int | None = None):
    """(``df`` computed once, its Arrow table when its size is within the limit or ``None``).

    The size is measured on the cluster first, so the driver never receives more than the limit. It is
    the size that rows take as Python objects, by their types and lengths.
    """
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    if limit <= 0:
        return df, None
    df = cut_lineage(df)
    size = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    return df, df.toArrow() if size <= limit else None
