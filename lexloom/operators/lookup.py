"""Replace every element of an array column by its value in a table.

The table is measured first. Within the broadcast limit the lookup runs inside the task on Arrow
batches and the corpus is not shuffled at all. Beyond it the most frequent elements, as many as fit, are
still found there, and only the others are exploded, joined and put back at their places.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.arrays import unnest
from ..session import broadcast_limit, cut_lineage, heaviest, measured, stored


def _index(table: pa.Table, key: str, value: str) -> tuple[dict, pa.Array]:
    values = table.column(value).combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], values.type)
    return {w: i for i, w in enumerate(table.column(key).to_pylist())}, values


def _batch_lookup(shared, value_type):
    def find(col: pa.Array) -> pa.Array:
        index, values = shared.value
        coded = pc.list_flatten(col).dictionary_encode()
        rows = pa.array([index.get(w) for w in coded.dictionary.to_pylist()], pa.int64())
        found = values.take(rows.take(coded.indices))
        lengths = pc.fill_null(pc.list_value_length(col), 0)
        ends = pc.cumulative_sum(lengths.cast(pa.int32()))
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        return pa.ListArray.from_arrays(offsets, found)

    return F.arrow_udf(find, returnType=T.ArrayType(value_type))


MORPHS = T.ArrayType(T.StructType([T.StructField("morph", T.StringType()), T.StructField("tag", T.StringType())]))


def per_distinct(segment: Callable[[str], list | None], kind: T.DataType = T.ArrayType(T.StringType())):
    """Arrow function: segment each distinct word of a batch once into a ``kind``, rebuild the lists."""
    arrow_kind = to_arrow_type(kind)

    def apply(col: pa.Array) -> pa.Array:
        coded = pc.list_flatten(col).dictionary_encode()
        made = pa.array([segment(w) for w in coded.dictionary.to_pylist()], arrow_kind)
        per_word = made.take(coded.indices)
        lengths = pc.fill_null(pc.list_value_length(col), 0)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(lengths.cast(pa.int32()))])
        return pa.ListArray.from_arrays(offsets, per_word)

    return F.arrow_udf(apply, returnType=T.ArrayType(kind))


def lookup(
    df: DataFrame,
    array: str,
    table: DataFrame,
    key: str,
    value: str,
    out: str,
    line_keys: Sequence[str],
    evenly: bool = False,
) -> DataFrame:
    """Add ``out``: for each element of ``array`` its ``value`` in ``table``, NULL where absent.

    ``key`` is unique in ``table``; ``line_keys`` identify a row of ``df``. ``evenly``: no element is more
    frequent than the others, so ``df`` is not worked out another time to count them.
    """
    pairs, small = measured(table.select(key, value))
    value_type = pairs.schema[value].dataType
    if small is not None:
        shared = df.sparkSession.sparkContext.broadcast(_index(small, key, value))
        return df.withColumn(out, _batch_lookup(shared, value_type)(F.col(array)))
    return _lookup_beyond(df, array, pairs, key, value, out, evenly)


def missing_from(shared, key_type):
    """Arrow function: (at, key) of every element that the shared index does not hold; NULLs are left out."""

    def miss(col: pa.Array) -> pa.Array:
        index = shared.value[0]
        flat = pc.list_flatten(col)
        coded = flat.dictionary_encode()
        absent = np.array([w is not None and w not in index for w in coded.dictionary.to_pylist()], dtype=bool)
        codes = coded.indices.fill_null(-1).to_numpy()
        open_ = (codes >= 0) & np.append(absent, False)[codes]
        lengths = pc.fill_null(pc.list_value_length(col), 0).to_numpy().astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(lengths)), lengths)[open_]
        where = np.flatnonzero(open_)
        at = pa.array((where - starts[owner]).astype(np.int32), pa.int32())
        ends = np.cumsum(np.bincount(owner, minlength=len(lengths)))
        items = pa.StructArray.from_arrays([at, flat.take(pa.array(where))], ["at", "key"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), items)

    kind = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("key", key_type)])
    return F.arrow_udf(miss, returnType=T.ArrayType(kind))


def _put_back(value_type):
    """Arrow function: the values of a row with others put at the places ``at``."""

    def put(values: pa.Array, at: pa.Array, others: pa.Array) -> pa.Array:
        flat, new = pc.list_flatten(values), pc.list_flatten(others)
        lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy().astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        take = np.arange(len(flat))
        if len(new):
            take[starts[pc.list_parent_indices(at).to_numpy()] + pc.list_flatten(at).to_numpy()] = len(flat) + np.arange(len(new))
        made = pa.concat_arrays([flat, new if new.type == flat.type else new.cast(flat.type)]).take(pa.array(take))
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), made)

    return F.arrow_udf(put, returnType=T.ArrayType(value_type))


def _lookup_beyond(df: DataFrame, array: str, pairs: DataFrame, key: str, value: str, out: str, evenly: bool = False) -> DataFrame:
    """Both ways: elements by how often they occur, the frequent ones in the task and the others in a join."""
    spark, value_type = df.sparkSession, pairs.schema[value].dataType
    if evenly:
        used, least = pairs.withColumn("_n", F.lit(0)), 1
    else:
        counts = unnest(df, [], array, key).groupBy(key).agg(F.count("*").alias("_n"))
        used = cut_lineage(counts.join(pairs, key, "left").select(key, value, "_n"))
        least = heaviest(used, "_n", broadcast_limit(spark))
    # Elements without a value are known, too, when they are frequent: they need no join.
    shared = spark.sparkContext.broadcast(_index(used.filter(F.col("_n") >= least).select(key, value).toArrow(), key, value))
    rest = missing_from(shared, used.schema[key].dataType)(F.col(array))
    marked = df.withColumns({out: _batch_lookup(shared, value_type)(F.col(array)), "_rest": rest})
    marked = stored(marked.withColumn("_row", F.monotonically_increasing_id()))
    tail = used.filter((F.col("_n") < least) & F.col(value).isNotNull()).select(key, value)
    elements = unnest(marked, ["_row"], "_rest", "_e").select("_row", F.col("_e.at").alias("_at"), F.col("_e.key").alias(key))
    found = elements.join(tail, key).groupBy("_row").agg(F.collect_list(F.struct("_at", F.col(value).alias("_v"))).alias("_found"))
    places = F.coalesce("_found._at", F.array().cast("array<int>"))
    values = F.coalesce("_found._v", F.array().cast(T.ArrayType(value_type)))
    put = _put_back(value_type)(F.col(out), places, values)
    return marked.drop("_rest").join(found, "_row", "left").withColumn(out, put).drop("_found", "_row")
