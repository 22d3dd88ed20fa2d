"""Exact top-k search by inner product over a bit-sliced index.

Candidates lie in blocks. The index of a block holds, for every component and each of its ``bits``
highest bits, a bitmap over the block's rows. For a query the slices are added, weighted by the bits
of its own components, with carry-save adders on whole bitmaps; a negative weight takes the
complement. The sum is again bit-sliced, and the k-th value is found from its most significant slice
downward. Bits that were cut off widen that value by a known bound: rows within it are the boundary
rows, whose exact products decide.

Queries and candidates meet as pairs of blocks of bounded size; what a pair yields is k rows for
each query, merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCK = 16_384  # candidates of a block
QUERY_BLOCK = 2_048
BITS = 6
LIMIT = 1 << 24  # from this size on, components are stored as doubles
WIDE_KEY = 2**2200  # above every score: components are below 2^1032


def usable(vector: Column) -> Column:
    """Not NULL, not empty, every component finite; NaN and NULL fail the test."""
    infinite = F.lit(float("inf"))
    inside = lambda x: F.coalesce((x.cast("double") > -infinite) & (x.cast("double") < infinite), F.lit(False))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(F.forall(vector, inside), F.lit(False))


def _floored(vector: np.ndarray) -> np.ndarray:
    """floor(256 x) / 256, which a double holds exactly, also where 256 x is beyond it."""
    return np.where(np.abs(vector) < 2.0**45, np.floor(256.0 * np.clip(vector, -(2.0**45), 2.0**45)) / 256.0, vector)


def _whole(vector: np.ndarray) -> list[int]:
    """256 x of floored components, as Python integers."""
    return [(n << 8) // d for n, d in map(float.as_integer_ratio, vector.tolist())]


class WideBlock:
    """Candidates whose products may be beyond 64 bits, as floored doubles.

    Products in double precision, with a bound on the error of each, leave the boundary rows, whose
    products are taken in Python integers.
    """

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        # Scaled by powers of two, so that no product overflows.
        self.scaled = np.ldexp(rows, -int(np.frexp(np.abs(rows).max())[1]))
        self.sizes = np.abs(self.scaled)
        self.known: dict[int, list[int]] = {}

    def search(self, weights: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, list[int]]:
        """As :meth:`SlicedBlock.search`, for a query of floored doubles."""
        among = np.flatnonzero(ids != own)
        if len(among) > k:
            scaled = np.ldexp(weights, -int(np.frexp(np.abs(weights).max())[1]))
            about, dim = self.scaled @ scaled, len(weights)
            # Twice the bound of a sum of rounded products, and what may fall below the smallest double.
            error = (dim + 2) * 2.0**-51 * (self.sizes @ np.abs(scaled)) + (dim + 2) * 2.0**-1060
            least = np.partition((about - error)[among], -k)[-k]
            among = among[(about + error)[among] >= least]
        asked = _whole(weights)
        scored = []
        for row in among.tolist():
            if row not in self.known:
                self.known[row] = _whole(self.rows[row])
            scored.append((-sum(a * b for a, b in zip(self.known[row], asked, strict=True)), int(ids[row]), row))
        best = sorted(scored)[:k]
        return np.array([row for _, _, row in best], np.int64), [-score for score, _, _ in best]


class SlicedBlock:
    """The bit-sliced index of a matrix of whole numbers, a row per candidate."""

    def __init__(self, rows: np.ndarray, bits: int = BITS):
        self.rows, self.n = rows, len(rows)
        low = rows.min(axis=0)
        spread = int((rows - low).max())
        self.shift = max(0, spread.bit_length() - bits)
        self.bits = bits
        top = (rows - low) >> self.shift
        words = -(-self.n // 64)
        self.slices = np.zeros((2, rows.shape[1], bits, words), np.uint64)
        for j in range(bits):
            packed = np.packbits(((top >> j) & 1).astype(bool), axis=0, bitorder="little")
            padded = np.zeros((words * 8, rows.shape[1]), np.uint8)
            padded[: len(packed)] = packed
            self.slices[0, :, j] = np.ascontiguousarray(padded.T).view(np.uint64)
        self.slices[1] = ~self.slices[0]
        self.all = self._bitmap(np.ones(self.n, bool))

    def _bitmap(self, flags: np.ndarray) -> np.ndarray:
        out = np.zeros(-(-self.n // 64) * 8, np.uint8)
        packed = np.packbits(flags, bitorder="little")
        out[: len(packed)] = packed
        return out.view(np.uint64)

    def _sum(self, weights: np.ndarray) -> list[np.ndarray]:
        """Slices of the weighted sum of the quantised components, lowest first."""
        size, sign = np.abs(weights), (weights < 0).astype(np.int64)
        columns: list[list[np.ndarray]] = []
        for i in range(int(size.max()).bit_length()):
            dims = np.flatnonzero((size >> i) & 1)
            if not len(dims):
                continue
            for j in range(self.bits):
                while len(columns) <= i + j:
                    columns.append([])
                columns[i + j].append(self.slices[sign[dims], dims, j])
        out, level = [], 0
        while level < len(columns):
            maps = np.concatenate(columns[level]) if columns[level] else self.slices[0, 0, :1] & np.uint64(0)
            carries = []
            while len(maps) > 2:  # full adders: three bitmaps to a sum and a carry
                m = len(maps) // 3
                a, b, c = maps[:m], maps[m : 2 * m], maps[2 * m : 3 * m]
                half = a ^ b
                carries.append((a & b) | (half & c))
                maps = np.concatenate([half ^ c, maps[3 * m :]])
            if len(maps) == 2:
                carries.append((maps[:1] & maps[1:]))
                maps = maps[:1] ^ maps[1:]
            out.append(maps[0])
            if carries:
                if level + 1 == len(columns):
                    columns.append([])
                columns[level + 1] += carries
            level += 1
        return out

    @staticmethod
    def _kth(slices: list[np.ndarray], among: np.ndarray, k: int) -> int:
        """The k-th largest value among rows, from the most significant slice downward."""
        value, needed, equal = 0, k, among
        for place in range(len(slices) - 1, -1, -1):
            ones = equal & slices[place]
            count = int(np.bitwise_count(ones).sum())
            if count >= needed:
                value |= 1 << place
                equal = ones
            else:
                needed -= count
                equal = equal & ~slices[place]
        return value

    @staticmethod
    def _at_least(slices: list[np.ndarray], among: np.ndarray, value: int) -> np.ndarray:
        """Rows whose value reaches ``value``."""
        if value <= 0:
            return among
        above, equal = among & np.uint64(0), among
        for place in range(len(slices) - 1, -1, -1):
            if value >> place & 1:
                equal = equal & slices[place]
            else:
                above |= equal & slices[place]
                equal = equal & ~slices[place]
        return above | equal

    def search(self, weights: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best rows by score, then id; rows with the id ``own`` are left out."""
        among = self.all & ~self._bitmap(ids == own)
        if weights.any():
            slices = self._sum(weights)
            present = int(np.bitwise_count(among).sum())
            if present > k:
                lost = int(np.abs(weights).sum()) * ((1 << self.shift) - 1)
                least = self._kth(slices, among, k) - lost // (1 << self.shift)
                among = self._at_least(slices, among, least)
        boundary = np.flatnonzero(np.unpackbits(among.view(np.uint8), count=self.n, bitorder="little"))
        scores = self.rows[boundary] @ weights
        best = np.lexsort((ids[boundary], -scores))[:k]
        return boundary[best], scores[best]


def _packed(vectors: DataFrame, name: str, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one dimension: block, dim, wide, ids, vectors (both as bytes).

    Vectors are floor(256 x) in 32 bits; those with a component of ``LIMIT`` or more lie in wide blocks,
    as floored doubles.
    """
    parts = max(1, -(-vectors.count() * 5 // (4 * size)))  # a little less than a block in each

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], tuple[list, list]] = {}

        def block(kind: tuple[int, bool]) -> pa.RecordBatch:
            ids, rows = held.pop(kind)
            dim, wide = kind
            rows = np.concatenate(rows)
            rows = rows if wide else (256.0 * rows).astype(np.int32)
            data = [dim], [wide], [np.array(ids, np.int64).tobytes()], [rows.tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array(d, t) for d, t in zip(data, (pa.int32(), pa.bool_(), pa.binary(), pa.binary()), strict=True)],
                ["dim", "wide", "ids", "vectors"],
            )

        for batch in batches:
            values, ends = batch.column("vector").values.to_numpy(), batch.column("vector").offsets.to_numpy()
            for row, i in enumerate(batch.column("vec_id").to_pylist()):
                vector = _floored(values[ends[row] : ends[row + 1]])
                kind = len(vector), bool(np.abs(vector).max() >= LIMIT / 256)
                ids, rows = held.setdefault(kind, ([], []))
                ids.append(i)
                rows.append(vector)
                if len(ids) == size:
                    yield block(kind)
        for kind in list(held):
            yield block(kind)

    packed = vectors.repartition(parts).mapInArrow(pack, "dim int, wide boolean, ids binary, vectors binary")
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), name)


def _matrix(ids: bytes, vectors: bytes, dim: int, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and whole numbers; those of a wide block are floored doubles."""
    if wide:
        return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.float64).reshape(-1, dim)
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.int32).reshape(-1, dim).astype(np.int64)


def _largest(matrix: np.ndarray) -> int:
    """No component of the whole numbers is larger."""
    top = float(np.abs(matrix).max())
    return max(1, _whole(np.array([top]))[0] if matrix.dtype == np.float64 else int(top))


def _as(matrix: np.ndarray, doubles: bool) -> np.ndarray:
    """The matrix as floored doubles or as 64-bit whole numbers."""
    if doubles:
        return matrix if matrix.dtype == np.float64 else matrix / 256.0
    return matrix if matrix.dtype == np.int64 else (256.0 * matrix).astype(np.int64)


def _sort_key(score: int) -> tuple[int, int | None, bytes | None]:
    """(beyond, score, key): the score if 64 bits hold it, else its side and bytes that sort as it does."""
    if -(1 << 63) <= score < 1 << 63:
        return 0, score, None
    return (1 if score > 0 else -1), None, (score + WIDE_KEY).to_bytes(276, "big")


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
    bits: int = BITS,
) -> DataFrame:
    """The ``k`` best candidates of every query: query_id, rank (from 1), vec_id, score.

    Queries are the rows for which the condition ``queries`` holds, candidates all rows but those
    with the query's own key. Components are floor(256 x); the score is their inner product, ties go
    to the smaller key. Rows without a key and vectors that are NULL, empty, or hold a NULL or non-finite
    component take no part; only vectors of equal length meet. Rows that repeat a key are candidates of
    their own, and queries with the results of each. Ranks are exact at every size of the components; a
    score that a BIGINT does not hold is NULL.
    """
    asks = F.coalesce(queries, F.lit(False)).alias("asks")
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).alias("raw"), asks).filter(F.col("vec_id").isNotNull() & usable(F.col("raw")))
    rows = rows.select("vec_id", "asks", F.transform("raw", lambda x: x.cast("double")).alias("vector"))
    candidates = _packed(rows.select("vec_id", "vector"), "topk-candidates", block)
    asked = _packed(rows.filter("asks").select("vec_id", "vector"), "topk-queries", query_block)
    asked = asked.selectExpr("dim", "block AS asked", "wide AS asked_wide", "ids AS asked_ids", "vectors AS asked_vectors")

    # Every query meets every candidate, as it must, but in pairs of blocks: a row stands for up to
    # ``block`` times ``query_block`` products, and both its sides are of bounded size.
    left = candidates.join(asked.select("dim", "asked"), "dim")
    right = asked.join(candidates.select("dim", "block"), "dim").drop("dim")
    work = left.join(right, ["block", "asked"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, matrix = _matrix(row["ids"], row["vectors"], row["dim"], row["wide"])
                asked_ids, asked_rows = _matrix(row["asked_ids"], row["asked_vectors"], row["dim"], row["asked_wide"])
                doubles = _largest(matrix) * _largest(asked_rows) * row["dim"] >= 1 << 62
                matrix, asked_rows = _as(matrix, doubles), _as(asked_rows, doubles)
                sliced = WideBlock(matrix) if doubles else SlicedBlock(matrix, bits)
                found: list[tuple[np.ndarray, ...]] = []
                scores: list[int] = []
                for place, (own, weights) in enumerate(zip(asked_ids, asked_rows, strict=True)):
                    at, best = sliced.search(weights, ids, int(own), k)
                    same = [np.full(len(at), x, np.int64) for x in (own, row["asked"], place)]
                    found.append((*same, ids[at]))
                    scores += map(int, best)
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                keys = list(zip(*map(_sort_key, scores), strict=True)) or [(), (), ()]
                columns += [pa.array(c, t) for c, t in zip(keys, (pa.int32(), pa.int64(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "asked", "place", "vec_id", "beyond", "score", "wide"])

    # Block and place tell apart queries that share a key.
    made = work.mapInArrow(search, "query_id bigint, asked bigint, place bigint, vec_id bigint, beyond int, score bigint, wide binary")
    order = F.col("beyond").desc(), F.col("score").desc(), F.col("wide").desc(), F.col("vec_id")
    best = Window.partitionBy("query_id", "asked", "place").orderBy(*order)
    return (
        made.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
