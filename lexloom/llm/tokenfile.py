"""Token ids on disk as wavelet matrices.

A shard holds the ids of consecutive documents, in ascending order of their keys, as one wavelet
matrix: for every bit of an id, from the highest, a plane of one bit for each token, after which the
tokens are parted stably by that bit. With counts of ones before every block of a plane, single
tokens are read, tokens counted and their places found straight from the planes, without unpacking
the rest. Each Spark partition writes one compressed Parquet file with a row per shard; a shard ends
at a document's end, once it holds ``SHARD_TOKENS`` tokens.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import Vocabulary, load_vocabulary, per_worker

SHARD_TOKENS = 1 << 22
MAX_PIECES = 400_000  # of a task's table of pieces between spaces, about 200 bytes each
RENEW = 20  # times as many pieces missed, before it starts anew
BLOCK = 512  # bits between two stored counts
SHARDS = (
    "part int, seq int, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, "
    "planes array<binary>, ranks array<binary>"
)


class WaveletMatrix:
    """Planes of ``width`` bits over ``n`` tokens; positions and counts are arrays."""

    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.planes, self.ranks = n, planes, ranks
        self.zeros = [n - int(r[-1]) for r in ranks]

    @classmethod
    def build(cls, tokens: np.ndarray, width: int = 16) -> WaveletMatrix:
        n, planes, ranks = len(tokens), [], []
        a = tokens
        for k in range(width - 1, -1, -1):
            if k == 7:
                a = a.astype(np.uint8)  # the planes above are done
            bit = ((a >> a.dtype.type(k)) & a.dtype.type(1)).astype(bool)
            plane = np.packbits(bit, bitorder="little")
            planes.append(plane)
            ranks.append(cls._counts(plane))
            a = np.concatenate([a[~bit], a[bit]])
        return cls(n, planes, ranks)

    @staticmethod
    def _counts(plane: np.ndarray) -> np.ndarray:
        padded = np.zeros(-(-len(plane) // (BLOCK // 8)) * (BLOCK // 64), np.uint64)
        padded.view(np.uint8)[: len(plane)] = plane
        ones = np.bitwise_count(padded).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        return np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones of the plane before each position."""
        plane, block = self.planes[level], i // BLOCK
        count = self.ranks[level][block].astype(np.int64)
        byte = block * (BLOCK // 8)
        for step in range(BLOCK // 8):  # whole bytes before the position
            at = byte + step
            inside = at < i // 8
            if not inside.any():
                break
            count[inside] += np.bitwise_count(plane[at[inside]])
        rest = (i % 8).astype(np.uint8)
        some = rest > 0
        mask = (np.left_shift(1, rest[some].astype(np.int64)) - 1).astype(np.uint8)
        count[some] += np.bitwise_count(plane[i[some] // 8] & mask)
        return count

    def _bit(self, level: int, i: np.ndarray) -> np.ndarray:
        return (self.planes[level][i // 8] >> (i % 8).astype(np.uint8)) & 1 == 1

    def access(self, positions) -> np.ndarray:
        """The tokens at ``positions``."""
        i = np.asarray(positions, np.int64).copy()
        out = np.zeros(len(i), np.int64)
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            out = out << 1 | bit
            i = np.where(bit, self.zeros[level] + ones, i - ones)
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` among positions [low, high) lie after the last plane."""
        width = len(self.planes)
        if token < 0 or token >> width:
            return 0, 0
        ends = np.array([low, high], np.int64)
        for level in range(width):
            ones = self._ones(level, ends)
            ends = self.zeros[level] + ones if token >> (width - 1 - level) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of ``token`` among positions [low, high)."""
        low, high = self._range(token, low, self.n if high is None else high)
        return high - low

    def locate(self, token: int) -> np.ndarray:
        """Positions of ``token``, ascending: from the last plane back up by select."""
        low, high = self._range(token, 0, self.n)
        i = np.arange(low, high, dtype=np.int64)
        width = len(self.planes)
        for level in range(width - 1, -1, -1):
            one = token >> (width - 1 - level) & 1
            i = self._select(level, i - self.zeros[level] if one else i, bool(one))
        return i

    def _select(self, level: int, k: np.ndarray, one: bool) -> np.ndarray:
        """Positions of the k-th (from 0) ones or zeros of the plane, by bisection on the counts."""
        low, high = np.zeros(len(k), np.int64), np.full(len(k), self.n, np.int64)
        while (low < high).any():
            middle = (low + high) // 2
            ones = self._ones(level, middle + 1)
            enough = (ones if one else middle + 1 - ones) > k
            high = np.where(enough & (low < high), middle, high)
            low = np.where(~enough & (low < high), middle + 1, low)
        return low

    def tokens(self) -> np.ndarray:
        """All tokens: the partings undone from the last plane to the first."""
        width = len(self.planes)
        kind = np.uint8
        a = np.zeros(self.n, kind)
        for level in range(width - 1, -1, -1):
            if level == width - 9:
                kind = np.uint16 if width <= 16 else np.uint32
                a = a.astype(kind)
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            out = np.empty(self.n, kind)
            zeros = self.zeros[level]
            out[~bit] = a[:zeros]
            out[bit] = a[zeros:] | kind(1 << (width - 1 - level))
            a = out
        return a


class PieceEncoder:
    """The library's encoding of whole texts, each distinct piece between spaces encoded once.

    A text is cut before spaces only where the file's splitting rule cuts as well: not where white
    space touches a space from both sides, and not in texts with added tokens. New pieces reach the
    library many at a time, strung together; the lengths of the tokens tell where each piece ends.
    A full table of pieces stays as it is until the texts have changed so far that it rarely helps.
    """

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use every core
        from tokenizers import Tokenizer

        vocabulary = Vocabulary(source)
        self.added = list(vocabulary.added)
        splitter = json.loads(source)["pre_tokenizer"] or {}
        self.cuts = splitter.get("type") == "ByteLevel" and splitter["use_regex"] and not splitter["add_prefix_space"]
        self.unsafe = re.compile(r"\s \s|\s \Z")
        self.library = Tokenizer.from_str(source)
        self.kind = np.uint16 if len(vocabulary.bytes_of) <= 1 << 16 else np.uint32
        self.sizes = np.array(list(map(len, vocabulary.bytes_of)), np.int64)
        self.marks = dict(zip(",.", self._whole([",", "."]), strict=True)) if self.cuts else {}
        self.known: dict[str, bytes] = {}  # by the piece without its space
        self.missed = 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        made = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in made]

    def _learn(self, pieces: set[str], odd: list[str]) -> dict[str, bytes]:
        """Ids of pieces with a space before each. A comma or full stop after letters is a word of its own."""
        stems = {p: p[:-1] for p in pieces if p[-1] in self.marks and p[:-1].isalpha()}
        made = dict(zip(odd, self._whole([" " + p for p in odd]), strict=True))
        plain = [p for p in {stems.get(p, p) for p in pieces} if p not in self.known]
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        width = np.dtype(self.kind).itemsize
        strung = self._whole([" " + " ".join(g) for g in groups])
        for group, data in zip(groups, strung, strict=True):
            ends = np.cumsum(self.sizes[np.frombuffer(data, self.kind)])
            borders = np.cumsum([len(p.encode()) + 1 for p in group])
            at = [0, *((np.searchsorted(ends, borders) + 1) * width).tolist()]
            made.update(zip(group, [data[i:j] for i, j in zip(at[:-1], at[1:], strict=True)], strict=True))
        for piece, stem in stems.items():
            made[piece] = (made.get(stem) or self.known[stem]) + self.marks[piece[-1]]
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, as numbers of ``kind``."""
        out: list[bytes] = [b""] * len(texts)
        whole: list[tuple[int, str]] = []
        cut: list[tuple[int, list[str], list]] = []
        new: set[str] = set()
        odd: set[str] = set()  # pieces with white space at an end, which are not kept
        get = self.known.get
        for n, text in enumerate(texts):
            if not self.cuts or any(a in text for a in self.added):
                whole.append((n, text))
                continue
            first, *rest = text.split(" ")
            found = list(map(get, rest))
            if None in found:
                missing = {p for p, x in zip(rest, found, strict=True) if x is None}
                here = {p for p in missing if not p or p[0].isspace() or p[-1].isspace()}
                if here and self.unsafe.search(text):
                    whole.append((n, text))
                    continue
                new |= missing - here
                odd |= here
            whole.append((n, first))
            cut.append((n, rest, found))
        made = self._learn(new, list(odd))
        for (n, _), ids in zip(whole, self._whole([t for _, t in whole]), strict=True):
            out[n] = ids
        for n, rest, found in cut:
            if None in found:
                found = [made[p] if x is None else x for p, x in zip(rest, found, strict=True)]
            out[n] += b"".join(found)
        if len(self.known) < MAX_PIECES:
            self.known.update((p, made[p]) for p in made.keys() - odd)
        else:
            self.missed += len(made)
            if self.missed > RENEW * MAX_PIECES:
                self.known, self.missed = {}, 0
        return out


def _shard_row(part: int, seq: int, ids: list, parts: list[bytes], kind, end_id: int) -> pa.RecordBatch:
    end = kind(end_id).tobytes()
    tokens = np.frombuffer(b"".join([x for p in parts for x in (p, end)]), kind)
    size = tokens.itemsize
    matrix = WaveletMatrix.build(tokens, 8 * size)
    row = {
        "part": part,
        "seq": seq,
        "n_tokens": len(tokens),
        "doc_ids": ids,
        "doc_tokens": [len(p) // size + 1 for p in parts],
        "planes": [x.tobytes() for x in matrix.planes],
        "ranks": [x.tobytes() for x in matrix.ranks],
    }
    schema = pa.schema(
        [("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64())]
        + [(c, pa.list_(pa.int64())) for c in ("doc_ids", "doc_tokens")]
        + [(c, pa.list_(pa.binary())) for c in ("planes", "ranks")]
    )
    return pa.RecordBatch.from_pylist([row], schema)


def write_tokens(
    docs: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text", shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode every whole text, append ``end_id`` and write the shards to ``folder``.

    Documents lie in ascending order of their keys (whole numbers; NULL first; rows that share a key
    by a hash of the text), NULL texts count as empty. Other columns are not written.
    """
    shared = load_vocabulary(docs.sparkSession, path)
    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(F.col(text)).alias("tie"),
    )
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(shared, PieceEncoder)
        ids: list = []
        parts: list[bytes] = []
        part, seq, held = 0, 0, 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if len(batch) else part
            texts = batch.column("text")
            for low in range(0, len(batch), 256):
                encoded = encoder.encode(texts.slice(low, 256).to_pylist())
                for doc, tokens in zip(batch.column("doc_id").slice(low, 256).to_pylist(), encoded, strict=True):
                    ids.append(doc)
                    parts.append(tokens)
                    held += len(tokens) // np.dtype(encoder.kind).itemsize + 1
                    if held >= shard_tokens:
                        yield _shard_row(part, seq, ids, parts, encoder.kind, end_id)
                        ids, parts, seq, held = [], [], seq + 1, 0
        if ids:
            yield _shard_row(part, seq, ids, parts, encoder.kind, end_id)

    numbered = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))
    numbered.mapInArrow(build, SHARDS).write.option("compression", "zstd").parquet(folder)


def open_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards written by :func:`write_tokens`, one row each."""
    return spark.read.schema(SHARDS).parquet(folder)


def _matrix(row: dict) -> WaveletMatrix:
    planes = [np.frombuffer(x, np.uint8) for x in row["planes"]]
    return WaveletMatrix(row["n_tokens"], planes, [np.frombuffer(x, np.uint32) for x in row["ranks"]])


def _per_shard(shards: DataFrame, make, columns: str) -> DataFrame:
    """``make`` (shard row, its matrix) gives a RecordBatch for every shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(len(batch)):
                row = batch.slice(number, 1).to_pylist()[0]
                yield make(row, _matrix(row))

    return shards.mapInArrow(run, columns)


def shard_starts(shards: DataFrame) -> DataFrame:
    """Tokens before every shard: part, seq, shard_start. Sums run inside a file, then over the files."""
    sizes = shards.select("part", "seq", "n_tokens")
    before = (Window.unboundedPreceding, -1)
    files = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    over_files = F.sum("_n").over(Window.orderBy("part").rowsBetween(*before))  # a row per file
    files = files.select("part", F.coalesce(over_files, F.lit(0)).alias("_file"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(*before))
    return (
        sizes.withColumn("_inside", F.coalesce(inside, F.lit(0)))
        .join(files, "part")
        .select("part", "seq", (F.col("_file") + F.col("_inside")).alias("shard_start"))
    )


def read_documents(shards: DataFrame) -> DataFrame:
    """One row per document, read from the shards: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is the unsigned checksum of
    its ids as little-endian 32-bit integers.
    """

    def documents(row: dict, matrix: WaveletMatrix) -> pa.RecordBatch:
        sizes = np.array(row["doc_tokens"], np.int64)
        ends = np.cumsum(sizes)
        data = matrix.tokens().astype("<u4").data.cast("B")
        crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
        n = len(sizes)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([row["part"]] * n, pa.int32()),
                pa.array([row["seq"]] * n, pa.int32()),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(ends - sizes),
                pa.array(sizes),
                pa.array(crc, pa.int64()),
            ],
            ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"],
        )

    columns = "part int, seq int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"
    rows = _per_shard(shards, documents, columns)
    return rows.join(shard_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """Occurrences of a token in every shard: part, seq, n. Two counts per plane are read."""

    def count(row: dict, matrix: WaveletMatrix) -> pa.RecordBatch:
        found = [[row["part"]], [row["seq"]], [matrix.count(token)]]
        types = (pa.int32(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found, types, strict=True)], ["part", "seq", "n"])

    return _per_shard(shards, count, "part int, seq int, n bigint")


def locate_token(shards: DataFrame, token: int) -> DataFrame:
    """Places of a token among all ids, in the order of the files: one column, ``place``."""

    def locate(row: dict, matrix: WaveletMatrix) -> pa.RecordBatch:
        at = matrix.locate(token)
        n = len(at)
        return pa.RecordBatch.from_arrays(
            [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()), pa.array(at)],
            ["part", "seq", "local"],
        )

    found = _per_shard(shards, locate, "part int, seq int, local bigint")
    return found.join(shard_starts(shards), ["part", "seq"]).select((F.col("shard_start") + F.col("local")).alias("place"))
