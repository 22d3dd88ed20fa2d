"""Morphological tokens as least-cost paths through a lattice of lexicon words.

A token's path is a chain of lexicon words and unknown words. Every word costs by itself, and every
pair of tags that follow one another costs what their connection costs. Costs are whole numbers; they
come from files or are estimated from tagged text. A token is worked on once, however often it
occurs.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.arrays import unnest
from ..session import broadcast_limit, cut_lineage, measured
from .lookup import MORPHS, lookup, per_distinct
from .tokenizers import distinct_tokens

LINE_KEYS = ("doc_id", "line_no")
SCALE = 100  # costs are hundredths of negative natural logarithms
UNSEEN = 1500  # of a connection that the table does not have
SLICE_BITS = 1 << 16  # of the table of bits that tells what is no word
EDGE = ""  # the tag before the first and after the last word


class Unknown(NamedTuple):
    """How words that the lexicon lacks are made of one class of characters."""

    tag: str
    cost: int
    per_character: int


#: By class of characters; a run of one class is one word, and so is its first character alone.
UNKNOWN: dict[str, Unknown] = {
    "hangul": Unknown("UNK", 1500, 150),
    "letter": Unknown("SL", 1200, 20),
    "digit": Unknown("SN", 600, 0),
    "ideograph": Unknown("SH", 1200, 60),
    "other": Unknown("SY", 800, 40),
}


def char_class(ch: str) -> str:
    code = ord(ch)
    if 0xAC00 <= code <= 0xD7A3 or 0x3131 <= code <= 0x318E:
        return "hangul"
    if 0x4E00 <= code <= 0x9FFF or 0x3400 <= code <= 0x4DBF or 0xF900 <= code <= 0xFAFF:
        return "ideograph"
    kind = unicodedata.category(ch)
    return "letter" if kind[0] in "LM" else "digit" if kind == "Nd" else "other"


def edges_of(token: str, words: Mapping[str, Sequence[tuple[str, int]]], longest: int, unknown: Mapping[str, Unknown]) -> list[list[tuple[int, str, int]]]:
    """For every end, the (start, tag, cost) of the words that end there."""
    ends: list[list[tuple[int, str, int]]] = [[] for _ in range(len(token) + 1)]
    classes = [char_class(ch) for ch in token]
    until = len(token)  # of the run of one class
    for start in range(len(token) - 1, -1, -1):
        if start + 1 < len(token) and classes[start] != classes[start + 1]:
            until = start + 1
        for end in range(start + 1, min(len(token), start + longest) + 1):
            ends[end].extend((start, tag, cost) for tag, cost in words.get(token[start:end], ()))
        rule = unknown[classes[start]]
        for end in {start + 1, until}:
            ends[end].append((start, rule.tag, rule.cost + rule.per_character * (end - start)))
    return ends


def cheapest_path(token: str, ends: list[list[tuple[int, str, int]]], connections: Mapping[tuple[str, str], int], unseen: int = UNSEEN) -> list[tuple[str, str]]:
    """(morph, tag) of the path of least cost; of equal ones, from the last word back, that with the longer
    word, then with the smaller tags."""
    best: list[dict[str, tuple[int, int, str]]] = [{EDGE: (0, 0, "")}]  # tag: cost, start, tag before
    for end in range(1, len(token) + 1):
        here: dict[str, tuple[int, int, str]] = {}
        for start, tag, cost in ends[end]:
            for before, (total, *_) in best[start].items():
                found = (total + connections.get((before, tag), unseen) + cost, start, before)
                if tag not in here or found < here[tag]:
                    here[tag] = found
        best.append(here)
    if not token:
        return []
    tag = min(best[-1], key=lambda t: (best[-1][t][0] + connections.get((t, EDGE), unseen), best[-1][t][1], t))
    path, end = [], len(token)
    while end:
        _, start, before = best[end][tag]
        path.append((token[start:end], tag))
        end, tag = start, before
    return path[::-1]


def lattice_tokenize(
    df: DataFrame,
    lexicon: DataFrame,
    connections: DataFrame,
    col: str = "tokens",
    out: str = "tagged",
    line_keys: Sequence[str] = LINE_KEYS,
    unknown: Mapping[str, Unknown] = UNKNOWN,
    unseen: int = UNSEEN,
) -> DataFrame:
    """Adds ``out``, the (morph, tag) pairs of the tokens of a line.

    ``lexicon``: (word, tag, cost), a word may have several tags; ``connections``: (before, after, cost)
    of tags, the empty tag standing for a token's edge. A lexicon within the broadcast limit goes to
    the tasks; of a larger one every distinct token gets the entries inside it by a join, which substrings that are
    surely no entry do not reach. Tags are few:
    their connections must fit the broadcast limit.
    """
    spark = df.sparkSession
    pairs, small = measured(connections.select("before", "after", F.col("cost").cast("bigint").alias("cost")))
    if small is None:
        small = pairs.toArrow() if pairs.count() <= 1_000_000 else None
    if small is None:
        raise ValueError("too many connections of tags")
    costs = {(a, b): c for a, b, c in zip(*[small.column(i).to_pylist() for i in range(3)], strict=True)}
    entries = lexicon.filter("word <> ''").groupBy("word", "tag").agg(F.min(F.col("cost").cast("bigint")).alias("cost"))
    by_word, whole = measured(entries.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("tag", "cost"))).alias("tags")))
    longest = by_word.agg(F.max(F.length("word"))).first()[0] or 1
    rule = dict(unknown)
    if whole is not None:
        known = {w: [(t["tag"], t["cost"]) for t in tags] for w, tags in zip(whole.column(0).to_pylist(), whole.column(1).to_pylist(), strict=True)}
        shared = spark.sparkContext.broadcast((known, costs))

        def segment(token: str) -> list[dict]:
            words, joined = shared.value
            return [{"morph": m, "tag": t} for m, t in cheapest_path(token, edges_of(token, words, longest, rule), joined, unseen)]

        return df.withColumn("_pieces", per_distinct(segment, MORPHS)(F.col(col))).withColumn(out, F.flatten("_pieces")).drop("_pieces")
    tokens = cut_lineage(distinct_tokens(df, col))
    inside = _likely_words(by_word, longest)(F.col("token"))
    subs = unnest(tokens.filter("token <> ''"), ["token"], inside, "word")
    own = subs.join(by_word, "word").groupBy("token").agg(F.collect_list(F.struct("word", "tags")).alias("words"))
    shared_costs = spark.sparkContext.broadcast(costs)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for token, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                known = {w["word"]: [(t["tag"], t["cost"]) for t in w["tags"]] for w in words or ()}
                path = cheapest_path(token, edges_of(token, known, longest, rule), shared_costs.value, unseen)
                made.append([{"morph": m, "tag": t} for m, t in path])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, _PIECES)], ["token", "pieces"])

    found = tokens.join(own, "token", "left").mapInArrow(search, "token string, pieces array<struct<morph: string, tag: string>>")
    return lookup(df, col, found, "token", "pieces", "_pieces", line_keys).withColumn(out, F.flatten("_pieces")).drop("_pieces")


_PIECES = to_arrow_type(MORPHS)


def _likely_words(by_word: DataFrame, longest: int):
    """Arrow function: the distinct substrings of a token but those that are surely no word.

    A table of bits, 16 a word and within the broadcast limit, is filled on the cluster slice by slice;
    a substring whose bit is not set is none of the words.
    """
    spark = by_word.sparkSession
    n = max(by_word.count(), 1)
    most = max(broadcast_limit(spark), SLICE_BITS >> 3).bit_length() + 2  # whole powers of two, at most the limit
    bits = 1 << max(SLICE_BITS.bit_length() - 1, min((16 * n).bit_length(), most, 32))
    at = F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(bits))
    slices = by_word.select(F.floor(at / SLICE_BITS).cast("int").alias("slice"), (at % SLICE_BITS).cast("int").alias("bit"))

    def fill(slice_: pa.Table) -> pa.Table:
        held = np.zeros(SLICE_BITS, bool)
        held[slice_.column("bit").to_numpy()] = True
        return pa.table({"slice": slice_.column("slice")[:1], "held": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})

    made = slices.distinct().groupBy("slice").applyInArrow(fill, "slice int, held binary").toArrow()
    table = np.zeros((bits // SLICE_BITS, SLICE_BITS >> 3), np.uint8)
    for i, held in zip(made.column(0).to_pylist(), made.column(1).to_pylist(), strict=True):
        table[i] = np.frombuffer(held, np.uint8)
    shared = spark.sparkContext.broadcast(table.tobytes())

    def words(col: pa.Array) -> pa.Array:
        table, mask = shared.value, bits - 1
        found = []
        for token in col.to_pylist():
            subs = {token[i:j] for i in range(len(token)) for j in range(i + 1, min(len(token), i + longest) + 1)}
            places = ((s, zlib.crc32(s.encode()) & mask) for s in subs)
            found.append([s for s, at in places if table[at >> 3] >> (at & 7) & 1])
        return pa.array(found, pa.list_(pa.string()))

    return F.arrow_udf(words, returnType="array<string>")


# ---------------------------------------------------------------- costs


def estimate_costs(tagged: DataFrame, col: str = "pieces") -> tuple[DataFrame, DataFrame]:
    """(lexicon, connections) from tokens as arrays of (morph, tag): hundredths of negative logarithms.

    A word costs by its share in its tag, a connection by the share of the tag that follows, one more
    counted for every pair of tags.
    """
    tokens = tagged.select(F.col(col).alias("p")).filter(F.size("p") > 0)
    tokens = cut_lineage(tokens.groupBy("p").agg(F.count("*").alias("times")))  # each distinct token once
    words = unnest(tokens, ["times"], "p", "m").groupBy(F.col("m.morph").alias("word"), F.col("m.tag").alias("tag")).agg(F.sum("times").alias("n"))
    words = cut_lineage(words)
    of_tag = words.groupBy("tag").agg(F.sum("n").alias("total"))
    cost = lambda share: F.round(-SCALE * F.ln(share)).cast("bigint")
    lexicon = words.join(of_tag, "tag").select("word", "tag", cost(F.col("n") / F.col("total")).alias("cost"))
    tags = F.transform("p", lambda m: m["tag"])
    before, after = F.concat(F.array(F.lit(EDGE)), tags), F.concat(tags, F.array(F.lit(EDGE)))
    pairs = unnest(tokens, ["times"], F.zip_with(before, after, lambda a, b: F.struct(a.alias("before"), b.alias("after"))), "c").select("times", "c.*")
    seen = cut_lineage(pairs.groupBy("before", "after").agg(F.sum("times").alias("n")))
    n_tags = seen.select("after").distinct().count()
    totals = seen.groupBy("before").agg(F.sum("n").alias("total"))
    share = (F.col("n") + 1) / (F.col("total") + F.lit(n_tags))
    return lexicon, seen.join(totals, "before").select("before", "after", cost(share).alias("cost"))
