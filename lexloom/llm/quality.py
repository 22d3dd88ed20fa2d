"""Quality rules on repetition: how much of a text lies in n-grams and lines that occur again in it.

Words get whole-number ids inside their text. A window of n words has a rolling hash made from that
of n - 1 words, for all lengths at once in numpy; windows whose hash occurs twice or more are
duplicated, and the characters of the words they cover are measured, each once. A text that repeats
itself, or is made of symbols, or has next to no words is rejected.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 20
BASE_WINDOW = 8
BASE_PERCENT = 30
#: Largest share of a text's word characters that may lie in duplicated n-grams, by n.
NGRAM_SHARES: dict[int, float] = {4: 0.5, 6: 0.4, 8: 0.3, 10: 0.25}
#: Largest share of characters in lines equal to an earlier line.
LINE_SHARE = 0.3
#: Largest number of symbols for each word.
SYMBOLS_PER_WORD = 0.1
SYMBOLS = b"#*$%&|<>"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

FIELDS = (
    ("n_words", "bigint"),
    ("word_chars", "bigint"),
    ("n_symbols", "bigint"),
    ("n_dup_lines", "bigint"),
    ("n_repeat_words", "bigint"),
    ("line_chars", "bigint"),
    ("dup_line_chars", "bigint"),
    ("ngram_chars", "array<bigint>"),
)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """64 well-spread bits for every id."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _covered(hashes: np.ndarray, n: int, n_words: int) -> np.ndarray | None:
    """Which words lie in a window of n words whose hash occurs twice or more; None: no word."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return None
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    starts = np.flatnonzero(twice)
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return np.cumsum(edges[:-1]) > 0


def measure(text: bytes, lengths: tuple[int, ...]) -> tuple:
    """The values of ``FIELDS`` for one text in UTF-8; characters are code points."""
    raw = np.frombuffer(text, np.uint8)
    space = _SPACE[raw]
    chars = np.concatenate([np.zeros(1, np.int64), np.cumsum((raw & 0xC0) != 0x80)])
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    starts, ends = edges[::2], edges[1::2]
    sizes = chars[ends] - chars[starts]
    words = text.split()  # of bytes: cut at these six characters only
    n_words = len(words)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n_words)

    lines = [line for line in text.split(b"\n") if line.strip()]
    seen: set[bytes] = set()
    line_chars = dup_chars = dup_lines = 0
    for line in lines:
        size = len(line.decode("utf-8", "replace"))
        line_chars += size
        if line in seen:
            dup_lines += 1
            dup_chars += size
        seen.add(line)

    base, shares = 0, dict.fromkeys(lengths, 0)
    if len(known) < n_words:  # else no window repeats
        mixed = _mixed(ids)
        rolling = mixed.copy()
        for n in range(2, min(n_words, max((*lengths, BASE_WINDOW))) + 1):
            rolling = rolling[:-1] * np.uint64(0xD1342543DE82EF95) + mixed[n - 1 :]
            if n == BASE_WINDOW or n in shares:
                covered = _covered(_mixed(rolling), n, n_words)
                if covered is None:
                    break  # nor does a longer window
                if n == BASE_WINDOW:
                    base = int(covered.sum())
                if n in shares:
                    shares[n] = int(sizes[covered].sum())
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    return n_words, int(sizes.sum()), n_symbols, dup_lines, base, line_chars, dup_chars, list(shares.values())


def measures(lengths: tuple[int, ...]):
    """Arrow function from texts to a struct of ``FIELDS``; NULL texts count as empty."""
    lengths = tuple(sorted(lengths))
    types = {"bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64())}

    def run(texts: pa.Array) -> pa.Array:
        rows = [measure(t.as_py() or b"", lengths) for t in texts.cast(pa.binary())]
        columns = zip(*rows, strict=True) if rows else [[] for _ in FIELDS]
        arrays = [pa.array(c, types[kind]) for c, (_, kind) in zip(columns, FIELDS, strict=True)]
        return pa.StructArray.from_arrays(arrays, [name for name, _ in FIELDS])

    schema = ", ".join(f"{name}: {kind}" for name, kind in FIELDS)
    return F.arrow_udf(run, returnType=f"struct<{schema}>")


def _verdict(shares: Mapping[int, float], line_share: float, symbols: float) -> tuple[Column, Column]:
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words"))
    bad = (F.col("dup_line_chars") > line_share * F.col("line_chars")) | (
        F.col("n_symbols") > symbols * F.col("n_words")
    )
    for place, n in enumerate(sorted(shares)):
        bad |= F.col("ngram_chars")[place] > shares[n] * F.col("word_chars")
    return base_failed, ~base_failed & ~bad


def judge_quality(
    docs: DataFrame,
    shares: Mapping[int, float] = NGRAM_SHARES,
    line_share: float = LINE_SHARE,
    symbols: float = SYMBOLS_PER_WORD,
    text: str = "text",
) -> DataFrame:
    """``docs`` with the measures of ``FIELDS``, ``base_failed`` and ``kept``.

    Every row is judged by its own text; NULL and empty texts have no words and fail. Input columns
    called like an added one are replaced. Empty tables stay empty.
    """
    lengths = tuple(sorted(shares))
    names = [name for name, _ in FIELDS]
    added = {*names, "base_failed", "kept", "_measures"}
    rest = [c for c in docs.columns if c.lower() not in added]
    measured = docs.select(*[F.col(f"`{c}`") for c in rest], measures(lengths)(F.col(text)).alias("_measures"))
    base_failed, kept = _verdict(shares, line_share, symbols)
    return (
        measured.select(*[F.col(f"`{c}`") for c in rest], "_measures.*")
        .withColumn("base_failed", base_failed)
        .withColumn("kept", kept)
    )
