"""Repeated runs of lines, found by a suffix array over line-ID sequences, and cut from later copies.

Every line with a word has an ID, its hash; a document is the sequence of its IDs. Lines whose ID
occurs once part the sequences into pieces and take no further place. The suffixes of what is left
are ranked by prefix doubling: by their first line, then, from the ranks of a suffix and of the one h
lines on, by their first 2 h lines. Suffixes of equal rank are an interval of the suffix array with
a common prefix of that many lines; a suffix alone in its rank is done.

A run counts from ``min_words`` words on. Whether a line lies in a run that occurs earlier is settled by the
shortest such windows: those that no line can be taken from at the end, begun at each line, and those
that no line can be taken from at the front, ended at each line. A window of l lines is told by the
ranks of its first and its last 2^k lines, 2^k <= l; windows hold at most ``min_words`` lines, so there are
at most 1 + log2(min_words) rounds. Of equal windows the first in document order stays.

Nothing meets by a hot line: ranks come from sorting by range and from sums for each rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import positions, stored

MIN_WORDS = 10


def _key_type(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line (its place among the document's lines with a word), h1, h2, words."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                of, place, high, low_half, words = [], [], [], [], []
                for row, text in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    number = 0
                    for line in (text or b"").split(b"\n"):
                        size = len(line.split())
                        if size:
                            digest = xxhash.xxh128_digest(line)
                            of.append(row)
                            place.append(number)
                            high.append(int.from_bytes(digest[:8], "little", signed=True))
                            low_half.append(int.from_bytes(digest[8:], "little", signed=True))
                            words.append(size)
                            number += 1
                rows = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(rows), part.column("text_hash").take(rows), pa.array(place, pa.int64())]
                    + [pa.array(high, pa.int64()), pa.array(low_half, pa.int64()), pa.array(words, pa.int64())],
                    ["doc_id", "text_hash", "line", "h1", "h2", "words"],
                )

    schema = f"doc_id {_key_type(docs, 'doc_id')}, text_hash bigint, line bigint, h1 bigint, h2 bigint, words bigint"
    return docs.select("doc_id", "text_hash", "text").mapInArrow(lines, schema)


def _sequence(lines: DataFrame) -> DataFrame:
    """The lines that occur again, each with ``pos``: its place in the sequence of all documents.

    Documents follow one another by key (NULL first), then by hash; a gap parts two documents, and
    a line that occurs once leaves one.
    """
    often = lines.groupBy("h1", "h2").count().filter("count > 1").drop("count")
    again = lines.join(often, ["h1", "h2"], "left_semi").dropDuplicates(["doc_id", "text_hash", "line"])
    again = stored(again, "repeated-lines")
    spans = again.groupBy("doc_id", "text_hash").agg((F.max("line") + 2).alias("span"))
    starts = positions(spans, [], ["doc_id", "text_hash"], "line-starts", "span", "first")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    starts = starts.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "first")
    return again.join(starts, same).withColumn("pos", F.col("first") + F.col("line")).drop("_doc", "_hash", "first", "span")


def _ranked(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Add ``out``: the number of rows with smaller ``keys``. ``rows`` hold a unique ``pos``."""
    ordered = stored(positions(rows, [], [*keys, "pos"], "suffix-order", None, "_place"), "suffix-places")
    least = ordered.groupBy(*keys).agg(F.min("_place").alias(out))
    return ordered.drop("_place").join(least, keys)


def suffix_ranks(sequence: DataFrame, lines: int) -> list[DataFrame]:
    """(pos, rank) by the first 1, 2, 4, ... lines, up to ``lines``, of suffixes that share their rank.

    A suffix that is missing in a table is unlike every other, or shorter.
    """
    ranks = _shared(_ranked(sequence.select("pos", "h1", "h2"), ["h1", "h2"], "rank"))
    rounds, h = [ranks], 1
    while 2 * h <= lines:
        after = ranks.select((F.col("pos") - h).alias("pos"), F.col("rank").alias("rank2"))
        both = stored(ranks.join(after, "pos"), "suffix-pairs")
        ranks = _shared(_ranked(both.withColumnRenamed("rank", "rank1"), ["rank1", "rank2"], "rank"))
        rounds.append(ranks)
        h *= 2
    return rounds


def _shared(ranks: DataFrame) -> DataFrame:
    often = ranks.groupBy("rank").count().filter("count > 1").select("rank")
    return stored(ranks.select("pos", "rank").join(often, "rank", "left_semi"), "ranks")


def shortest_windows(lines: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first line, number of lines) of the windows of a document's repeated lines, without repeats."""
    found = set()
    n = len(lines)
    for forward in (True, False):
        for i in range(n):
            total, j, step = 0, i, 1 if forward else -1
            while 0 <= j < n and abs(lines[j] - lines[i]) == abs(j - i):
                total += words[j]
                if total >= min_words:
                    found.add((min(lines[i], lines[j]), abs(j - i) + 1))
                    break
                j += step
    return sorted(found)


def _windows(sequence: DataFrame, min_words: int) -> DataFrame:
    """(pos, size) of the shortest windows of every document."""

    def run(rows: pa.Array) -> pa.Array:
        out = []
        for value in rows.to_pylist():
            value = sorted((x["line"], x["words"], x["pos"]) for x in value)
            windows = shortest_windows([x[0] for x in value], [x[1] for x in value], min_words)
            shift = value[0][2] - value[0][0]
            out.append([{"pos": first + shift, "size": size} for first, size in windows])
        return pa.array(out, pa.list_(pa.struct([("pos", pa.int64()), ("size", pa.int64())])))

    found = F.arrow_udf(run, returnType="array<struct<pos: bigint, size: bigint>>")
    rows = sequence.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("line", "words", "pos")).alias("rows"))
    return rows.select(F.explode(found("rows")).alias("w")).select("w.pos", "w.size")


def later_copies(sequence: DataFrame, min_words: int) -> DataFrame:
    """(pos, size) of every shortest window that occurs earlier."""
    windows = stored(_windows(sequence, min_words), "windows")
    longest = windows.agg(F.max("size")).first()[0] or 0  # at most min_words
    rounds = suffix_ranks(sequence, longest)
    told = None
    for k, ranks in enumerate(rounds):
        h = 1 << k
        own = windows.filter((F.col("size") >= h) & (F.col("size") < 2 * h)).withColumn("last", F.col("pos") + F.col("size") - h)
        own = own.join(ranks.withColumnRenamed("rank", "head"), "pos")
        own = own.join(ranks.withColumnsRenamed({"pos": "last", "rank": "tail"}), "last").drop("last")
        told = own if told is None else told.unionByName(own)
    told = stored(told, "told-windows")
    first = told.groupBy("size", "head", "tail").agg(F.min("pos").alias("least"), F.count("*").alias("n")).filter("n > 1")
    return told.join(first, ["size", "head", "tail"]).filter("pos > least").select("pos", "size")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines of later copies: adds n_lines, deleted (ranges of lines) and rewrites ``text``.

    A run of consecutive lines with at least ``min_words`` words that occurs earlier, in a document with
    a smaller key or higher up in the same one, is deleted; runs do not reach over the end of a
    document, and lines without a word are not counted and stay, but at the edges of a text of which all
    lines went. ``deleted`` holds [from, to) pairs of places among the lines with a word. Documents
    with the same key follow one another by a hash of the text, NULL keys come first; rows equal in
    key and text count as one document, and each of them loses the same lines. NULL texts have no
    lines and stay NULL. Input columns called like an added one are replaced.
    """
    hashed = docs.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").alias("text"))
    sequence = stored(_sequence(stored(line_table(hashed), "lines")), "sequence")
    copies = sequence.join(later_copies(sequence, min_words), "pos").groupBy("doc_id", "text_hash")
    copies = copies.agg(F.collect_list(F.struct("line", "size")).alias("windows"))
    copies = stored(copies.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"}), "later-copies")

    names = {text.lower(), "n_lines", "deleted"}
    rest = [c for c in docs.columns if c.lower() not in names]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    same = F.col("_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("_text") == F.col("_hash"))
    joined = rows.join(copies, same, "left").withColumn("_cut", _cut(F.col("_text"), F.col("windows")))
    columns = [F.col("_row").getField(c).alias(c) if c in rest else F.col("_cut.text").alias(c) for c in docs.columns if c in rest or c.lower() == text.lower()]
    return joined.select(*columns, "_cut.n_lines", "_cut.deleted")


def cut_text(text: str, windows: list[tuple[int, int]]) -> tuple[str, int, list[int]]:
    """(``text`` without the lines of the windows, its number of lines with a word, bounds of the ranges)."""
    lines = text.split("\n")
    counted = [i for i, line in enumerate(lines) if line.encode().split()]
    gone = {line for first, size in windows for line in range(first, first + size)}
    bounds: list[int] = []
    for at in sorted(gone):
        if bounds and bounds[-1] == at:
            bounds[-1] = at + 1
        else:
            bounds += [at, at + 1]
    away = {counted[at] for at in gone}
    kept = "\n".join(line for i, line in enumerate(lines) if i not in away)
    return kept if len(gone) < len(counted) else "", len(counted), bounds


def _cut(text: Column, windows: Column) -> Column:
    def run(texts: pa.Array, starts: pa.Array) -> pa.Array:
        out: list[str | None] = []
        sizes, ranges = [], []
        for value, found in zip(texts, starts, strict=True):
            whole = value.as_py()
            if not found.is_valid:
                out.append(whole)
                sizes.append(sum(1 for line in (whole or "").encode().split(b"\n") if line.split()))
                ranges.append([])
                continue
            kept, n, bounds = cut_text(whole, [(x["line"], x["size"]) for x in found.as_py()])
            out.append(kept)
            sizes.append(n)
            ranges.append(bounds)
        arrays = [pa.array(out, pa.string()), pa.array(sizes, pa.int64()), pa.array(ranges, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(arrays, ["text", "n_lines", "deleted"])

    made = F.arrow_udf(run, returnType="struct<text: string, n_lines: bigint, deleted: array<bigint>>")
    return made.asNondeterministic()(text, windows)  # so that it runs once for all its fields
