"""Spacing model: how often a gap between two characters holds a space, given its neighbours.

A decision at a gap depends on the two characters before and the two after it. Corpus gaps are
therefore reduced to distinct four-character windows first, both for training and for applying.

Our rule: contexts of (2,0) (1,1) (0,2) (2,1) (1,2) characters before and after the gap; a space
goes in where the count-weighted mean over the contexts seen ``min_seen`` times or more reaches
``threshold``; existing spaces stay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import unnest
from ..session import measured
from .lookup import lookup
from .rows import drop_blank

LINE_KEYS = ("doc_id", "line_no")
# Characters before and after the gap for every context kind.
CONTEXTS = ((2, 0), (1, 1), (0, 2), (2, 1), (1, 2))
EDGE = "\U0010ffff"  # a code point no text holds; stands for "no character here" in a window
EDGE_POINT = ord(EDGE)
MAX_ALPHABET = 1 << 15  # four characters over a smaller alphabet fit into one 64-bit number
# The code points of white space.
WHITE = np.array(
    [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    dtype=np.uint32,
)


# ---------------------------------------------------------------- windows of a batch of lines


def _gaps(lines: pa.Array):
    """All lines of a batch as code points, with the gaps between neighbouring visible characters.

    Returns (points, line ends, place of the character before each gap, window of four code points
    per gap, whether the gap holds white space).
    """
    texts = [t or "" for t in lines.to_pylist()]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    blank = np.isin(points, WHITE)
    seen = np.flatnonzero(~blank)
    line = np.searchsorted(ends, seen, side="right")
    chars = points[seen]
    edge = np.full(2, EDGE_POINT, dtype=np.uint32)
    padded, owner = np.concatenate([edge, chars, edge]), np.concatenate([[-1, -1], line, [-1, -1]])

    def at(k: int) -> np.ndarray:
        there = owner[2 + k : 2 + k + len(chars)] == line
        return np.where(there, padded[2 + k : 2 + k + len(chars)], EDGE_POINT)

    inside = at(1) != EDGE_POINT
    windows = np.stack([at(-1), chars, at(1), at(2)], axis=1)[inside]
    spaced = blank[np.minimum(seen + 1, max(len(points) - 1, 0))][inside] if len(points) else inside
    return points, ends, seen[inside], windows, spaced


def _window_codes(windows: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """One number per window over an alphabet of code points; -1 where a character is not in it."""
    if not len(alphabet):
        return np.full(len(windows), -1, dtype=np.int64)
    places = np.minimum(np.searchsorted(alphabet, windows), len(alphabet) - 1)
    known = (alphabet[places] == windows).all(axis=1)
    codes = np.zeros(len(windows), dtype=np.int64)
    for k in range(4):
        codes = codes * len(alphabet) + places[:, k]
    return np.where(known, codes, -1)


def _count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to (win, n_space, n_total), summed per batch."""
    for batch in batches:
        _, _, _, windows, spaced = _gaps(batch.column(0))
        if not len(windows):
            continue
        alphabet = np.unique(windows)
        if len(alphabet) < MAX_ALPHABET:
            _, first, where = np.unique(_window_codes(windows, alphabet), return_index=True, return_inverse=True)
            kinds = windows[first]
        else:
            kinds, where = np.unique(windows, axis=0, return_inverse=True)
        text = kinds.astype(np.uint32).tobytes().decode("utf-32-le")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([text[k : k + 4] for k in range(0, len(text), 4)]),
                pa.array(np.bincount(where.ravel(), weights=spaced, minlength=len(kinds)).astype(np.int64)),
                pa.array(np.bincount(where.ravel(), minlength=len(kinds)).astype(np.int64)),
            ],
            names=["win", "n_space", "n_total"],
        )


def _windows(lines: DataFrame, col: str) -> DataFrame:
    """(win, n_space, n_total): distinct windows of all lines."""
    counted = lines.select(col).mapInArrow(_count_windows, "win string, n_space bigint, n_total bigint")
    return counted.groupBy("win").agg(F.sum("n_space").alias("n_space"), F.sum("n_total").alias("n_total"))


def _insert_spaces(shared):
    """Arrow function: lines with a space put into every unspaced gap whose window is listed."""

    def apply(lines: pa.Array) -> pa.Array:
        if not len(lines):
            return lines
        alphabet, wanted = shared.value
        points, ends, before, windows, spaced = _gaps(lines)
        hit = ~spaced & np.isin(_window_codes(windows, alphabet), wanted)
        places = before[hit] + 1
        out = np.insert(points, places, ord(" ")).astype(np.uint32).tobytes().decode("utf-32-le")
        stops = ends + np.searchsorted(places, ends, side="left")
        made = [out[a:b] for a, b in zip(np.concatenate([[0], stops[:-1]]), stops)]
        return pa.array(made, pa.string())

    return F.arrow_udf(apply, returnType="string")


def _contexts(win: Column) -> Column:
    """The contexts of a window that lie inside the line, as (kind, text)."""
    found = [
        F.struct(
            F.lit(f"{before}{after}").alias("ctx_kind"),
            F.substring(win, 3 - before, before + after).alias("ctx"),
        )
        for before, after in CONTEXTS
    ]
    return F.filter(F.array(*found), lambda c: ~F.contains(c["ctx"], F.lit(EDGE)))


def spacing_train(lines: DataFrame, col: str = "line") -> DataFrame:
    """(ctx_kind, ctx, n_space, n_total) over all gaps of all lines."""
    return (
        unnest(_windows(lines, col), ["n_space", "n_total"], _contexts(F.col("win")), "c")
        .groupBy("c.ctx_kind", "c.ctx")
        .agg(F.sum("n_space").alias("n_space"), F.sum("n_total").alias("n_total"))
    )


def spacing_apply(
    lines: DataFrame,
    model: DataFrame,
    col: str = "line",
    min_seen: int = 10,
    threshold: float = 0.5,
    line_keys: Sequence[str] = LINE_KEYS,
) -> DataFrame:
    """Insert the missing spaces; blank lines are dropped, all other columns stay.

    The windows that want a space are found once per distinct window. Within the broadcast limit
    they are applied inside the task; a larger table is joined to the gaps of every line.
    """
    stripped = drop_blank(lines.withColumn(col, tx.strip_line(col)), col)
    windows = _windows(stripped, col).filter(F.col("n_space") < F.col("n_total")).select("win")
    seen = model.filter(F.col("n_total") >= min_seen)
    wanted = (
        unnest(windows, ["win"], _contexts(F.col("win")), "c")
        .select("win", "c.*")
        .join(seen, ["ctx_kind", "ctx"])
        .groupBy("win")
        .agg((F.sum("n_space") / F.sum("n_total")).alias("p"))
        .filter(F.col("p") >= threshold)
        .select("win")
    )
    wanted, small = measured(wanted)
    if small is not None:
        text = "".join(small.column(0).to_pylist())
        table = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).reshape(-1, 4)
        alphabet = np.unique(table)
        if len(alphabet) < MAX_ALPHABET:
            shared = lines.sparkSession.sparkContext.broadcast((alphabet, np.sort(_window_codes(table, alphabet))))
            return stripped.withColumn(col, _insert_spaces(shared)(F.col(col)))
    return _joined_apply(stripped, wanted, col, line_keys)


def _joined_apply(stripped: DataFrame, wanted: DataFrame, col: str, line_keys: Sequence[str]) -> DataFrame:
    """The same by a join: one row per gap, put together again by line key and position."""
    units = stripped.withColumn(
        "_units", F.regexp_extract_all(F.col(col), F.lit(rf"(?U)([^{tx.SPACE[1:-1]}]{tx.SPACE}*)"), F.lit(1))
    )
    none = F.array(F.lit(EDGE))
    chars = F.transform("_units", lambda u: F.substring(u, 1, 1))
    lined = units.withColumn("_chars", F.concat(none, chars, none, none))
    size = F.size("_units")
    shifted = [F.slice("_chars", F.lit(1 + k), size) for k in range(4)]
    wins = F.transform(F.arrays_zip(*[s.alias(f"c{k}") for k, s in enumerate(shifted)]), lambda w: F.concat(*[w[f"c{k}"] for k in range(4)]))
    keyed = lined.withColumn("_wins", wins)
    found = lookup(keyed, "_wins", wanted.withColumn("insert", F.lit(True)), "win", "insert", "_insert", line_keys)
    spaced = F.zip_with(
        "_units", "_insert", lambda u, ins: F.when(ins & (F.length(u) == 1), F.concat(u, F.lit(" "))).otherwise(u)
    )
    return found.withColumn(col, F.array_join(spaced, "")).drop("_units", "_chars", "_wins", "_insert")
