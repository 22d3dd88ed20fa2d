"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

Two words one edit apart have letter counts whose squared distance is two at most (one letter more,
or one letter for another), and lengths that are equal or adjacent. Squared distances of a whole
block of words come from one product of its matrix of letter counts with itself; pairs of at most
two are then verified letter by letter.

Not every pair of words meets. Cut the shorter word of a pair into three parts: an edit touches one
of them, so the pair agrees on the two others, a beginning and an ending of known lengths. Words are
grouped by length class and by each such two thirds, which loses no pair; a pair that agrees in
several ways counts where it agrees first. A group beyond ``TILE`` words or ``TILE_LETTERS`` letters
is cut into tiles that meet pair by pair in different tasks, so no task holds a group of any size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import unnest
from .common import stored

MIN_LETTERS = 7
MIN_COUNT = 2
DELETE_EACH = 31  # of the hashes of document and word, one in so many loses a letter
FORM_TIMES = 10
TILE = 4096  # words of a group that meet in one task
TILE_LETTERS = 8 << 20
BLOCK = 512  # rows of one matrix
BLOCK_LETTERS = 4 << 20
EXACT_SINGLE = 4000  # longest word whose squared counts single precision holds exactly

_COLUMN = np.full(256, -1, np.int64)  # of a letter in the matrix of counts
_COLUMN[ord("a") : ord("z") + 1] = np.arange(26)
_COLUMN[0xC0:] = np.arange(26, 90)
N_LETTERS = 90


# ---------------------------------------------------------------- words


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the words of all whole texts with at least ``MIN_LETTERS`` letters seen ``MIN_COUNT`` times.

    Runs of letters are lower-cased (A-Z only), and those that the hash of document and run marks lose
    the letter it points at. Counts combine before the shuffle.
    """
    runs = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[A-Za-z\u00C0-\u00FF]{{{MIN_LETTERS},}}"), F.lit(0))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = unnest(docs, [key.alias("_key")], runs, "_run")
    lowered = F.when(F.rlike("_run", F.lit("[A-Z]")), F.translate("_run", ascii_uppercase, ascii_lowercase)).otherwise(F.col("_run"))
    found = found.select("_key", lowered.alias("_run")).withColumn("_hash", F.crc32(F.concat("_key", F.lit(":"), "_run")))
    at = (F.col("_hash") % F.char_length("_run")).cast("int")
    cut = F.concat(F.substr("_run", F.lit(1), at), F.substr("_run", at + 2))
    word = F.when(F.col("_hash") % DELETE_EACH == 0, cut).otherwise(F.col("_run"))
    words = found.select(word.alias("word")).filter(F.char_length("word") >= MIN_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_COUNT)


# ---------------------------------------------------------------- groups


def _agreements(cls: Column) -> list[Column]:
    """The three pairs of thirds in which two words of the length class can agree, as texts of ``word``."""
    third = F.floor(cls / 3).cast("int")
    head = lambda n: F.substr("word", F.lit(1), n)
    tail = lambda n: F.substr("word", F.char_length("word") - n + 1, n)
    return [tail(cls - third), F.concat(head(third), tail(third)), head(cls - third)]


def keyed_words(words: DataFrame) -> DataFrame:
    """(key, cls, part, word, n): every word in the groups where it may meet words one edit apart.

    ``cls`` is the length of the shorter word of a pair; a word belongs to its own length's class and
    to that of words one letter shorter. Keys are 64-bit hashes: what they bring together wrongly is
    told apart by the verification.
    """
    size = F.char_length("word")
    keys = [
        F.struct(F.xxhash64(cls, F.lit(part), shared).alias("key"), cls.alias("cls"), F.lit(part).cast("int").alias("part"))
        for cls in (size, size - 1)
        for part, shared in enumerate(_agreements(cls), 1)
    ]
    spread = words.select("word", "n", F.explode(F.array(*keys)).alias("_key")).select("_key.*", "word", "n")
    return spread.filter(F.col("cls") >= MIN_LETTERS)


def _tiled(keyed: DataFrame) -> DataFrame:
    """``keyed`` with the tiles that meet (``low`` and ``high``) and the word's own tile."""
    large = keyed.groupBy("key").agg(F.count("*").alias("_n"), F.sum(F.char_length("word")).alias("_letters"))
    tiles = F.greatest(F.ceil(F.col("_n") / TILE), F.ceil(F.col("_letters") / TILE_LETTERS)).cast("int")
    large = stored(large.select("key", tiles.alias("_tiles")).filter("_tiles > 1"), "tiles")  # Spark knows its size
    joined = keyed.join(large, "key", "left").withColumn("_tiles", F.coalesce("_tiles", F.lit(1)))
    joined = joined.withColumn("tile", F.pmod(F.xxhash64("word", F.lit("tile")), F.col("_tiles")).cast("int"))
    met = joined.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    return met.select(
        "key", "cls", "part", "word", "n", "tile", F.least("tile", "_other").alias("low"), F.greatest("tile", "_other").alias("high")
    )


# ---------------------------------------------------------------- blocks


def letter_counts(letters: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of letter counts for every word; ``letters`` are the words one after the other."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    counts = np.bincount(rows * N_LETTERS + _COLUMN[letters], minlength=len(sizes) * N_LETTERS).reshape(len(sizes), N_LETTERS)
    return counts.astype(np.float32 if sizes.max(initial=0) < EXACT_SINGLE else np.float64)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between all rows of two blocks, from their Gram matrix; exact, all numbers being whole."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


class Block:
    """Some words as matrices: letters from the left, letters from the right, counts of letters."""

    def __init__(self, words: list[bytes]):
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        joined = np.frombuffer(b"".join(words), np.uint8)
        width = int(self.sizes.max(initial=1))
        self.left = np.zeros((len(words), width), np.uint8)
        self.right = np.zeros((len(words), width), np.uint8)
        places = np.arange(width)
        self.left[places < self.sizes[:, None]] = joined
        self.right[places >= width - self.sizes[:, None]] = joined
        self.counts = letter_counts(joined, self.sizes)


def _shared_ends(a: Block, i: np.ndarray, b: Block, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the common beginnings and endings of pairs of words."""
    width = min(a.left.shape[1], b.left.shape[1])
    shorter = np.minimum(a.sizes[i], b.sizes[j])
    first = np.logical_and.accumulate(a.left[i, :width] == b.left[j, :width], axis=1).sum(axis=1)
    same = a.right[i, a.right.shape[1] - width :] == b.right[j, b.right.shape[1] - width :]
    last = np.logical_and.accumulate(same[:, ::-1], axis=1).sum(axis=1)
    return np.minimum(first, shorter), np.minimum(last, shorter)


def near_pairs(a: Block, b: Block, group_a, group_b, cls_a, part_a, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of a, of b) of one group that are exactly one edit apart and agree first in this group's part.

    ``same``: both blocks are one, and a pair is told once.
    """
    close = squared_distances(a.counts, b.counts) <= 2
    close &= group_a[:, None] == group_b[None, :]
    i, j = np.nonzero(np.triu(close, 1) if same else close)
    out_i, out_j = [], []
    step = max(1, BLOCK_LETTERS // max(a.left.shape[1], b.left.shape[1]))  # pairs verified at once
    for low in range(0, len(i), step):
        x, y = i[low : low + step], j[low : low + step]
        first, last = _shared_ends(a, x, b, y)
        shorter, longer = np.minimum(a.sizes[x], b.sizes[y]), np.maximum(a.sizes[x], b.sizes[y])
        cls, part = cls_a[x], part_a[x]
        third = cls // 3
        agree = np.where(last >= cls - third, 1, np.where((first >= third) & (last >= third), 2, 3))
        right = (shorter == cls) & (longer <= cls + 1) & (first + last >= longer - 1) & ((first < shorter) | (longer > shorter))
        right &= agree == part
        out_i.append(x[right])
        out_j.append(y[right])
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (i, j)


def _best(i: np.ndarray, j: np.ndarray, n: np.ndarray, words: list[bytes]) -> Iterable[tuple[int, int, int]]:
    """(row, near words, best of them) for every row in ``i``: the most frequent, then the smallest word."""
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((place[j], -n[j], i))
    i, j = i[order], j[order]
    rows, starts, counts = np.unique(i, return_index=True, return_counts=True)
    return zip(rows.tolist(), counts.tolist(), j[starts].tolist(), strict=True)


def _group_rows(words: list[bytes], n: np.ndarray, group: np.ndarray, cls: np.ndarray, part: np.ndarray, tile: np.ndarray, across: np.ndarray) -> list:
    """(word, near words, count of the best, the best) over rows sorted by group; in groups ``across`` two
    tiles, pairs of one tile are left to its own meeting."""
    longest = max(map(len, words))
    step = max(1, min(BLOCK, BLOCK_LETTERS // longest))
    cuts = [(low, min(low + step, len(words))) for low in range(0, len(words), step)]
    found_i, found_j = [], []
    for x, (low, high) in enumerate(cuts):
        a = Block(words[low:high])
        for y in range(x, len(cuts)):
            from_, to = cuts[y]
            if group[from_] != group[high - 1] and y > x:
                break  # sorted: no group reaches further
            b = a if y == x else Block(words[from_:to])
            i, j = near_pairs(a, b, group[low:high], group[from_:to], cls[low:high], part[low:high], y == x)
            i, j = i + low, j + from_
            right = ~across[i] | (tile[i] != tile[j])
            found_i.append(i[right])
            found_j.append(j[right])
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    both_i, both_j = np.concatenate([i, j]), np.concatenate([j, i])
    return [(words[r], count, int(n[b]), words[b]) for r, count, b in _best(both_i, both_j, n, words)] if len(i) else []


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, whole groups at a time."""

    def solve(table: pa.Table) -> pa.RecordBatch | None:
        columns = [table.column(c).combine_chunks() for c in ("key", "low", "high", "cls", "part", "n", "tile")]
        key, low, high, cls, part, n, tile = [c.to_numpy(zero_copy_only=False) for c in columns]
        edges = np.flatnonzero((key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (cls[1:] != cls[:-1]) | (part[1:] != part[:-1])) + 1
        group = np.zeros(len(key), np.int64)
        group[edges] = 1
        group = np.cumsum(group)
        alone = np.bincount(group)[group] == 1
        rows = np.flatnonzero(~alone)
        if not len(rows):
            return None
        words = [w.encode("latin-1") for w in table.column("word").take(pa.array(rows)).to_pylist()]
        made = _group_rows(words, n[rows], group[rows], cls[rows], part[rows], tile[rows], (low != high)[rows])
        if not made:
            return None
        word, count, best_n, best = zip(*made, strict=True)
        text = lambda values: pa.array([v.decode("latin-1") for v in values], pa.string())
        return pa.RecordBatch.from_arrays([text(word), pa.array(count, pa.int64()), pa.array(best_n, pa.int64()), text(best)], ["word", "n_near", "best_n", "best"])

    def last_group(table: pa.Table) -> int:
        """Where the last group begins."""
        same = np.ones(table.num_rows, bool)
        for name in ("key", "low", "high"):
            values = table.column(name).to_numpy()
            same &= values == values[-1]
        return 0 if same.all() else int(table.num_rows - np.argmin(same[::-1]))

    held = None  # the rows of a group that may go on; at most two tiles
    for batch in batches:
        for at in range(0, batch.num_rows, 8 * BLOCK):
            part = pa.Table.from_batches([batch.slice(at, 8 * BLOCK)])
            part = part if held is None else pa.concat_tables([held, part])
            cut = last_group(part)
            held = part.slice(cut)
            made = solve(part.slice(0, cut)) if cut else None
            if made is not None:
                yield made
    made = solve(held) if held is not None else None
    if made is not None:
        yield made


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best_n, best) for every row of ``words`` (word, n): how many words are exactly one
    inserted, deleted or replaced letter away, and the most frequent of them (ties: the smallest).

    ``words`` holds each word once, of letters a to z and U+00C0 to U+00FF, not shorter than
    ``MIN_LETTERS``; words without a near one have 0 and NULLs.
    """
    met = _tiled(keyed_words(words)).repartition("key", "low", "high").sortWithinPartitions("cls", "part", "key", "low", "high")
    found = met.mapInArrow(_search, "word string, n_near bigint, best_n bigint, best string")
    best = F.struct((-F.col("best_n")).alias("less"), F.col("best"))
    found = found.select("word", F.lit(None).cast("bigint").alias("n"), "n_near", best.alias("_best"))
    none = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast(found.schema["_best"].dataType).alias("_best"))
    summed = none.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("_best").alias("_best"))
    return summed.select("word", "n", "n_near", (-F.col("_best.less")).alias("best_n"), F.col("_best.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that follow one another; a form is ten times as frequent, so
    paths are short, and each round doubles the steps."""
    forms = stored(forms, "forms")
    while True:
        above = forms.select(F.col("word").alias("root"), F.col("root").alias("_top"))
        further = forms.join(above, "root", "left")
        forms = stored(further.select("word", F.coalesce("_top", "root").alias("root"), F.col("_top").isNotNull().alias("_moved")), "forms")
        moved = forms.filter("_moved").limit(1).count()
        forms = forms.drop("_moved")
        if not moved:
            return forms


def group_variants(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of at least seven letters seen twice or more.

    Words are the maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF of whole texts, with A-Z in
    lower case; where the crc32 of doc_id and run divides by 31, the run loses one letter. ``form`` is
    the most frequent word one edit away if it is ten times as frequent, ``root`` the end of the path
    of forms. NULL and empty texts have no words, a NULL doc_id counts as an empty one, repeated rows
    count each, and an empty table gives no rows.
    """
    words = stored(count_words(docs, text), "words")
    near = stored(near_words(words), "near")
    close = F.col("best_n") >= FORM_TIMES * F.col("n")
    roots = _roots(near.filter(close).select("word", F.col("best").alias("root")))
    return near.join(roots, "word", "left").select(
        "word",
        "n",
        "n_near",
        F.when(close, F.col("best")).alias("form"),
        F.when(close, F.col("best_n")).alias("form_n"),
        F.coalesce("root", "word").alias("root"),
    )
