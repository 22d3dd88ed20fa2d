"""Weighted rendezvous hashing: every record picks its shard by itself.

A shard's score for a key is ``weight / -ln(u)`` with ``u`` a uniform hash of key and shard number;
the highest score wins, ties go to the smaller shard. A further shard changes no other score, so it
only takes rows into itself; a removed last shard only gives its own rows away. Nothing is shuffled
for the choice: the shard is a column expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import positions, stored


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard number of ``key`` (any type; NULL is a key of its own) over weighted shards.

    A weight of 0 takes no rows; without any positive weight there is no shard to choose.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    table = F.array(*[F.lit(float(w)) for w in weights])

    def score(weight: Column, shard: Column) -> Column:
        unit = (F.shiftrightunsigned(F.xxhash64(key, shard), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return weight / -F.ln(unit)

    # The one-element array binds the scores, so that they are computed once.
    place = F.transform(F.array(F.transform(table, score)), lambda s: F.array_position(s, F.array_max(s)))
    return (place[0] - 1).cast("int")


def shard_records(
    docs: DataFrame, weights: Sequence[float], grown: Sequence[float], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per record: key, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 16; a NULL text counts as an empty one. ``slot`` numbers
    the rows of a shard from 0 without gaps, in the order of key, checksum and size (repeated rows
    get consecutive slots, NULL keys come first). ``grown_shard`` is the shard under ``grown``.
    Other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    text_or_empty = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text_or_empty) + 16).cast("bigint").alias("size"),
        F.crc32(text_or_empty.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
    )
    # Written first: sorting by range reads its input twice, and this one holds no texts.
    rows = stored(rows, "shards")
    placed = positions(rows, ["shard"], ["doc_id", "text_crc32", "size"], "slots")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
