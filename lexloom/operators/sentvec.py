"""Sentence vectors, nearest-row labels, evaluation and a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import unnest
from ..session import broadcast_limit, cut_lineage, heaviest, measured, row_bytes, stored
from .lookup import missing_from
from .order import with_ordinal

LINE_KEYS = ("doc_id",)


def sif_weights(word_probs: DataFrame, a: float = 1e-4) -> DataFrame:
    """(word, weight) = a / (a + p): smooth inverse frequency (Arora et al. 2017)."""
    return word_probs.select("word", (F.lit(a) / (F.lit(a) + F.col("p"))).alias("weight"))


def sentence_vectors(
    df: DataFrame,
    vectors: DataFrame,
    weights: DataFrame | None = None,
    col: str = "tokens",
    out: str = "vec",
    keys: Sequence[str] = LINE_KEYS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Mean of the known words' vectors, weighted when ``weights`` (word, weight) is given, beside the columns
    ``keep`` of ``df``, or all.

    NULL when no word is known. Vectors within the broadcast limit are averaged inside the task. Of a
    larger table the vectors of the most frequent words, as many as fit, are summed there, and the
    other words meet their vectors in blocks by frequency; a row and a block that it has words of have one sum.
    """
    words = vectors.select("word", "vec", F.lit(1.0).alias("weight"))
    if weights is not None:
        words = vectors.select("word", "vec").join(weights.select("word", "weight"), "word")
    words, small = measured(words)
    if small is not None:
        shared = _shared_vectors(df.sparkSession, small)
        return df.select(*(keep or df.columns), _in_task(shared, whole=True)(F.col(col)).alias(out))
    return _means_beyond(df, words, col, out, keep or df.columns)


def _shared_vectors(spark, table: pa.Table):
    """Broadcast (index, matrix, weights); a word without a vector has the index -1."""
    known = table.column("vec").combine_chunks()
    names, have = table.column("word").to_pylist(), known.is_valid().to_pylist()
    places = np.cumsum(have) - 1
    index = {w: int(place) if there else -1 for w, place, there in zip(names, places, have)}
    flat = known.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(sum(have), -1) if any(have) else np.zeros((0, 1))
    return spark.sparkContext.broadcast((index, matrix, table.column("weight").to_numpy()[np.array(have, dtype=bool)]))


def _in_task(shared, whole: bool):
    """Arrow function: the mean vector of the known words of every row or, not ``whole``, their sum and last
    the sum of their weights."""

    def mean(col: pa.Array) -> pa.Array:
        index, matrix, weight = shared.value
        coded = pc.list_flatten(col).dictionary_encode()
        rows = np.array([index.get(w, -1) for w in coded.dictionary.to_pylist()], dtype=np.int64)
        ids = rows[coded.indices.to_numpy()] if len(coded) else np.zeros(0, dtype=np.int64)
        lengths = pc.fill_null(pc.list_value_length(col), 0).to_numpy()
        owner = np.repeat(np.arange(len(lengths)), lengths)[ids >= 0]
        ids = ids[ids >= 0]
        w = weight[ids]
        total = np.bincount(owner, weights=w, minlength=len(lengths))
        sums = np.zeros((len(lengths), matrix.shape[1]))
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        for start in range(0, len(cuts), 256):  # a few rows at a time bounds the gathered vectors
            part = cuts[start : start + 256]
            end = cuts[start + 256] if start + 256 < len(cuts) else len(ids)
            block = matrix[ids[part[0] : end]] * w[part[0] : end, None]
            sums[owner[part]] = np.add.reduceat(block, part - part[0], axis=0)
        if whole:
            means = [sums[r] / total[r] if total[r] > 0 else None for r in range(len(lengths))]
        else:
            means = [np.append(sums[r], total[r]) if total[r] > 0 else None for r in range(len(lengths))]
        return pa.array(means, pa.list_(pa.float64()))

    return F.arrow_udf(mean, returnType="array<double>")


WORD_BLOCK_BYTES = 128 << 20  # of vectors that a task holds
BLOCK_CELLS = 1 << 22  # words of rows that a block of vectors meets in one task, about


def _means_beyond(df: DataFrame, words: DataFrame, col: str, out: str, keep: Sequence[str]) -> DataFrame:
    spark = df.sparkSession
    first = words.filter("vec is not null").select(F.size("vec")).first()
    width = first[0] if first else 0
    counts = unnest(df, [], col, "word").groupBy("word").agg(F.count("*").alias("_n"))
    held = words.select("word", row_bytes(words).alias("_bytes"), F.col("vec").isNotNull().alias("_has"))
    used = cut_lineage(counts.join(held, "word", "left"))
    least = heaviest(used, "_n", broadcast_limit(spark), F.coalesce("_bytes", F.octet_length("word") + F.lit(192)).cast("bigint"))
    # Frequent words without a vector are known to have none.
    head = used.filter(F.col("_n") >= least).join(words, "word", "left")
    shared = _shared_vectors(spark, head.select("word", "vec", "weight").toArrow())
    rest = F.transform(missing_from(shared, words.schema["word"].dataType)(F.col(col)), lambda e: e["key"])
    marked = df.select(*keep, _in_task(shared, whole=False)(F.col(col)).alias("_sums"), rest.alias("_rest"))
    marked = stored(marked.withColumn("_row", F.monotonically_increasing_id()))
    # Blocks by frequency: most of the rest of a row lies in the first blocks, so few blocks have a sum for it.
    tail = with_ordinal(used.filter((F.col("_n") < least) & F.col("_has")).select("word", "_n"), [F.desc("_n"), "word"], "at")
    size = max(1, WORD_BLOCK_BYTES // max(width * 8, 1))
    tail = cut_lineage(tail.withColumn("block", F.floor(F.col("at") / size)))
    # A block that many words of rows ask for goes to several tasks: a row for each block.
    copies = tail.groupBy("block").agg(F.ceil(F.sum("_n") / BLOCK_CELLS).alias("copies"))
    tail = tail.join(F.broadcast(copies), "block").select("word", "block", "copies", (F.col("at") % size).alias("at"))
    none = lambda kind: F.lit(None).cast(kind)
    vectors = unnest(tail.join(words, "word"), ["block", none("bigint").alias("row"), "at", "vec", "weight"], F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1), "copy")
    vectors = vectors.select("block", "copy", "row", "at", F.col("vec").cast("array<double>").alias("vec"), F.col("weight").cast("double").alias("weight"))
    cells = unnest(marked, [F.col("_row").alias("row")], "_rest", "word").join(tail, "word")
    copy = F.pmod(F.xxhash64("row"), F.col("copies")).alias("copy")
    cells = cells.select("block", copy, "row", "at", none("array<double>").alias("vec"), none("double").alias("weight"))
    met = vectors.unionByName(cells).repartition("block", "copy").sortWithinPartitions("block", "copy", "row")  # vectors first

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, matrix, last = None, None, None

        def made(rows: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            flat = pa.array(sums.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, width + 1), pa.int32()), flat)
            return pa.RecordBatch.from_arrays([pa.array(rows), lists], ["_row", "_sums"])

        for batch in batches:
            block, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(part) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if low == high:
                    continue
                own = batch.slice(low, high - low)
                if place != (block[low], part[low]):
                    if last is not None:
                        yield made(*last)
                    place, last = (block[low], part[low]), None
                    matrix = np.zeros((0, width + 1))
                at, n = own.column(3).to_numpy(), own.column(2).null_count
                if n:
                    top = int(at[:n].max()) + 1
                    if top > len(matrix):
                        matrix = np.concatenate([matrix, np.zeros((min(size, max(top, 2 * len(matrix))) - len(matrix), width + 1))])
                    weight = own.column(5).slice(0, n).to_numpy()
                    matrix[at[:n], :-1] = own.column(4).slice(0, n).flatten().to_numpy().reshape(n, -1) * weight[:, None]
                    matrix[at[:n], -1] = weight
                if n == own.num_rows:
                    continue
                rows = own.column(2).slice(n).to_numpy()
                cut = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
                sums = np.add.reduceat(matrix[at[n:]], cut, axis=0)
                rows = rows[cut]
                if last is not None:
                    if last[0][0] == rows[0]:  # a row that two batches hold a part of
                        sums[0] += last[1][0]
                    else:
                        yield made(*last)
                if len(rows) > 1:
                    yield made(rows[:-1], sums[:-1])
                last = rows[-1:], sums[-1:]
        if last is not None:
            yield made(*last)

    parts = met.mapInArrow(add, "_row bigint, _sums array<double>")
    both = marked.filter("_sums is not null").select("_row", "_sums").unionByName(parts)

    def divide(rows: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        known = sums[:, -1] > 0
        made = sums[known, :-1] / sums[known, -1:]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, made.size + 1, max(width, 1)), pa.int32()), pa.array(made.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(rows[known]), lists], ["_row", out])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(0).to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            sums = np.add.reduceat(batch.column(1).flatten().to_numpy().reshape(len(rows), -1), cut, axis=0)
            rows = rows[cut]
            if last is not None:
                if last[0][0] == rows[0]:  # a row that two batches hold a part of
                    sums[0] += last[1][0]
                else:
                    yield divide(*last)
            if len(rows) > 1:
                yield divide(rows[:-1], sums[:-1])
            last = rows[-1:], sums[-1:]
        if last is not None:
            yield divide(*last)

    # In numpy: a hundred sums side by side are too many for one aggregate.
    means = both.repartition("_row").sortWithinPartitions("_row").mapInArrow(mean, f"_row bigint, `{out}` array<double>") if width else both.select("_row", F.col("_sums").alias(out)).limit(0)
    return marked.select(*keep, "_row").join(means, "_row", "left").drop("_row")


# ---------------------------------------------------------------- nearest labelled row

TRAIN_BLOCK, TEST_BLOCK = 8192, 2048  # rows of a block at most
BLOCK_BYTES = 4 << 20  # and about its bytes at most
ASKED = 256  # test rows whose similarities are in memory at the same time


def _blocks(df: DataFrame, key: str, vec: str, label: str, size: int) -> DataFrame:
    """(block, dim, keys, labels, rows): unit vectors of one length by key, written once; a block has at most
    ``size`` rows and, but for a single longer row, ``BLOCK_BYTES``."""
    parts = max(1, -(-df.count() * 5 // (4 * size)))  # a little less than a block in each

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            keys, labels, rows = zip(*sorted(held.pop(dim), key=lambda r: r[0]))
            columns = [pa.array([dim], pa.int32()), pa.array([keys], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string()))]
            columns.append(pa.array([_unit_rows(np.stack(rows)).tobytes()], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["dim", "keys", "labels", "rows"])

        for batch in batches:
            for row in range(batch.num_rows):  # one vector at a time
                k, v, t = (batch.column(c)[row].as_py() for c in range(3))
                if v is None or k is None:
                    continue
                own = held.setdefault(len(v), [])
                own.append((k, None if t is None else str(t), np.array(v, np.float64)))
                if len(own) == size or len(own) * len(v) * 8 >= BLOCK_BYTES:
                    yield block(len(v))
        for dim in list(held):
            yield block(dim)

    packed = df.select(F.col(key).cast("bigint"), vec, label).repartition(parts)
    made = packed.mapInArrow(pack, "dim int, keys array<bigint>, labels array<string>, rows binary")
    return cut_lineage(made.withColumn("block", F.monotonically_increasing_id()))


def nearest_label(
    train: DataFrame, test: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label"
) -> DataFrame:
    """(key, nearest, cosine, label, predicted): each test row's most similar training row.

    Both sides are packed into blocks of bounded size. Every block of training rows moves once, to the
    task that holds it while the blocks of test rows of its length pass by; no side passes through the
    driver. A pair of blocks yields one best row per test row, and ``max_by`` joins them. Ties go to the
    smaller training key; only vectors of one length are compared.
    """
    known = _blocks(train, key, vec, label, TRAIN_BLOCK)
    asked = _blocks(test, key, vec, label, TEST_BLOCK).select("dim", F.col("block").alias("asks"), "keys", "labels", "rows")
    asked = asked.join(known.select("dim", "block"), "dim")
    none = F.lit(-1).cast("bigint").alias("asks")
    met = known.select("block", none, "keys", "labels", "rows").unionByName(asked.drop("dim"))
    met = met.repartition("block").sortWithinPartitions("block", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                asks, keys = batch.column(1)[row].as_py(), batch.column(2)[row].values.to_numpy()
                rows = np.frombuffer(batch.column(4)[row].as_buffer(), np.float64).reshape(len(keys), -1)
                if asks < 0:
                    held = (keys.copy(), rows.copy(), batch.column(3)[row].values)
                    continue
                for low in range(0, len(keys), ASKED):
                    sims = rows[low : low + ASKED] @ held[1].T
                    np.round(sims, 12, out=sims)
                    top = sims.argmax(axis=1)  # rows by key: the first of equal ones is the smallest
                    columns = [pa.array(keys[low : low + ASKED]), pa.array(held[0][top]), pa.array(sims[np.arange(len(top)), top]), held[2].take(pa.array(top))]
                    yield pa.RecordBatch.from_arrays(columns, names=[key, "nearest", "cosine", "predicted"])

    found = met.mapInArrow(search, f"{key} bigint, nearest bigint, cosine double, predicted string")
    rank = F.struct(F.col("cosine"), -F.col("nearest"))
    top = found.groupBy(key).agg(F.max_by(F.struct("nearest", "cosine", "predicted"), rank).alias("b"))
    return test.select(key, label).join(top.select(key, "b.*"), key)


# ---------------------------------------------------------------- nearest rows by lists

SAMPLE_ROWS = 16_384  # of the training rows that centroids are fitted on
LISTS = 256
PROBES = 24
ROUNDS = 10


def fit_centroids(sample: np.ndarray, lists: int = LISTS, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit vectors: spherical k-means from evenly drawn rows."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.permutation(len(sample))[:lists]]
    for _ in range(rounds):
        nearest = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        filled = np.bincount(nearest, minlength=len(centroids)) > 0
        centroids = np.where(filled[:, None], _unit_rows(sums), centroids)
    return centroids


def _in_lists(df: DataFrame, centroids, key: str, vec: str, label: str, probes: int) -> DataFrame:
    """(key, label, vec, list): every row in its nearest lists, its vector at unit length."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                values = batch.column(2).to_pylist()
                known = [i for i, v in enumerate(values) if v is not None and len(v) == centroids.value.shape[1] and batch.column(0)[i].is_valid]
                if not known:
                    continue
                rows = _unit_rows(np.array([values[i] for i in known], np.float64))
                near = np.argsort(-(rows @ centroids.value.T), axis=1, kind="stable")[:, :probes]
                owner = pa.array(np.repeat(known, near.shape[1]))
                vectors = pa.array([v.tobytes() for v in np.repeat(rows, near.shape[1], axis=0)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), batch.column(1).take(owner), vectors, pa.array(near.ravel().astype(np.int64))], ["k", "t", "v", "list"])

    given = df.select(F.col(key).cast("bigint").alias("k"), F.col(label).cast("string").alias("t"), F.col(vec).alias("v"))
    return given.mapInArrow(assign, "k bigint, t string, v binary, list bigint")


def nearest_label_approx(
    train: DataFrame, test: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label", lists: int = LISTS, probes: int = PROBES
) -> DataFrame:
    """As :func:`nearest_label`, looking only into the lists of training rows next to each test row.

    Centroids are fitted on at most ``SAMPLE_ROWS`` training rows, chosen by a hash; every training row
    lies in the list of its nearest centroid, and every test row is compared, exactly, with the rows of
    its ``probes`` nearest lists. A list with many rows is cut into blocks, which the rows that ask meet
    one by one.
    """
    usable = train.filter(F.col(vec).isNotNull())
    n = usable.count()
    mark = F.pmod(F.xxhash64(key), F.lit(1 << 31))
    thin = usable.filter(mark <= min(1 << 31, (2 * SAMPLE_ROWS << 31) // max(n, 1)))
    sample = [r[0] for r in thin.orderBy(mark, key).limit(SAMPLE_ROWS).select(vec).collect()]
    none = test.select(key, label, F.lit(None).cast("bigint").alias("nearest"), F.lit(None).cast("double").alias("cosine"), F.lit(None).cast("string").alias("predicted"))
    if not sample:
        return none.filter("1 = 0")
    dim = len(sample[0])
    centroids = fit_centroids(_unit_rows(np.array([v for v in sample if len(v) == dim], np.float64)), lists)
    shared = train.sparkSession.sparkContext.broadcast(centroids)  # lists times a vector
    part = F.pmod(F.xxhash64("k"), F.col("_parts"))
    known = cut_lineage(_in_lists(train, shared, key, vec, label, 1))
    sizes = known.groupBy("list").agg(F.ceil(F.count("*") / TRAIN_BLOCK).alias("_parts"))  # a row a list
    known = known.join(F.broadcast(sizes), "list").select("list", part.alias("part"), F.lit(0).alias("asks"), "k", "t", "v")
    asked = _in_lists(test, shared, key, vec, label, probes).join(F.broadcast(sizes), "list")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("part")
    asked = asked.select("list", every, F.lit(1).alias("asks"), "k", "t", "v")
    met = known.unionByName(asked).repartition("list", "part").sortWithinPartitions("list", "part", "asks", "k")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, block = None, [], None
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                lists_, parts, asks, keys = (batch.column(c).to_numpy() for c in range(4))
                vectors = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.float64).reshape(batch.num_rows, -1)
                cuts = np.flatnonzero((np.diff(lists_) != 0) | (np.diff(parts) != 0) | (np.diff(asks) != 0)) + 1
                for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                    if place != (lists_[low], parts[low]):
                        place, held, block = (lists_[low], parts[low]), [], None
                    if not asks[low]:
                        held.append((keys[low:high], vectors[low:high], batch.column(4).slice(low, high - low)))
                        continue
                    if not held:
                        continue
                    if block is None:
                        block = (np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), pa.concat_arrays([h[2] for h in held]))
                    sims = np.round(vectors[low:high] @ block[1].T, 12)
                    top = sims.argmax(axis=1)  # rows by key: the first of equal ones is the smallest
                    columns = [pa.array(keys[low:high]), pa.array(block[0][top]), pa.array(sims[np.arange(len(top)), top]), block[2].take(pa.array(top))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "nearest", "cosine", "predicted"])

    found = met.mapInArrow(search, "key bigint, nearest bigint, cosine double, predicted string")
    rank = F.struct(F.col("cosine"), -F.col("nearest"))
    top = found.groupBy("key").agg(F.max_by(F.struct("nearest", "cosine", "predicted"), rank).alias("b"))
    return test.select(key, label).join(top.select(F.col("key").alias(key), "b.*"), key)


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(length == 0, 1.0, length)


# ---------------------------------------------------------------- evaluation


def confusion(pred: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    return pred.groupBy(label, predicted).agg(F.count("*").alias("cnt"))


def evaluate(pred: DataFrame, label: str = "label", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """Row count and accuracy, per model when ``by`` names its column."""
    right = (F.col(label).cast("string") == F.col(predicted).cast("string")).cast("double")
    return pred.groupBy(*by).agg(F.count("*").alias("n"), F.avg(right).alias("accuracy"))


class Probe(NamedTuple):
    """A linear classifier: its labels, a row of weights and a bias for each, and what training left of the
    objective in each round."""

    labels: list[str]
    weights: np.ndarray
    losses: list[float]


LABELS = 1000  # that a classifier tells apart


def _label_rows(df: DataFrame, vec: str, label: str) -> DataFrame:
    return df.filter(F.col(vec).isNotNull() & F.col(label).isNotNull()).select(F.col(vec).alias("v"), F.col(label).cast("string").alias("y"))


def _with_bias(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column(0)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    return np.concatenate([flat, np.ones((len(flat), 1))], axis=1)


def fit_probe(train: DataFrame, vec: str = "vec", label: str = "label", max_iter: int = 50, ridge: float = 1e-3, tolerance: float = 1e-9) -> Probe:
    """One logistic regression for each label against the rest, by Newton steps over sums of the rows.

    The objective of a label is the mean logistic loss and half of ``ridge`` times the squared weights,
    the bias left out. A step that would raise it is halved, so it never rises. Tasks send sums whose
    size is that of a label's weights squared; at most ``LABELS`` labels are told apart.
    """
    rows = cut_lineage(_label_rows(train, vec, label))
    labels = [r.y for r in rows.groupBy("y").count().orderBy("y").limit(LABELS + 1).collect()]
    if len(labels) > LABELS:
        raise ValueError(f"more than {LABELS} labels")
    first = rows.select(F.size("v")).first()
    width, n = (first[0] if first else 0) + 1, rows.count()
    weights, losses = np.zeros((len(labels), width)), []
    if not labels:
        return Probe(labels, weights, losses)
    penalty = np.full(width, ridge)
    penalty[-1] = 1e-12  # the bias, but for a system that stays solvable

    def sums(w: np.ndarray, steps: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gram, slope, loss = np.zeros((len(labels), width, width)), np.zeros((len(labels), width)), np.zeros(len(labels))
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _with_bias(batch)
                signs = np.where(np.array(batch.column(1).to_pylist())[:, None] == np.array(labels)[None, :], 1.0, -1.0)
                margin = signs * (x @ w.T)
                loss += np.logaddexp(0, -margin).sum(axis=0)
                if steps:
                    p = np.exp(-np.logaddexp(0, margin))
                    slope -= (signs * p).T @ x
                    for c in range(len(labels)):
                        gram[c] += (x * (p[:, c] * (1 - p[:, c]))[:, None]).T @ x
            part = [pa.array(range(len(labels)), pa.int32())]
            part += [pa.array(list(v.reshape(len(labels), -1)), pa.list_(pa.float64())) for v in (gram, slope, loss)]
            yield pa.RecordBatch.from_arrays(part, ["c", "gram", "slope", "loss"])

        made = rows.mapInArrow(add, "c int, gram array<double>, slope array<double>, loss array<double>")

        def total(frame: pd.DataFrame) -> pd.DataFrame:
            added = {k: [np.sum(np.stack(sorted(frame[k].to_list(), key=lambda v: v.tolist())), axis=0)] for k in ("gram", "slope", "loss")}
            return pd.DataFrame({"c": frame["c"].iloc[:1], **added})

        found = made.groupBy("c").applyInPandas(total, "c int, gram array<double>, slope array<double>, loss array<double>").orderBy("c").collect()
        shape = lambda name, *d: np.array([r[name] for r in found]).reshape(len(labels), *d)
        return shape("gram", width, width) / n, shape("slope", width) / n, shape("loss") / n

    def objective(loss: np.ndarray, w: np.ndarray) -> np.ndarray:
        return loss + (w * w * penalty).sum(axis=1) / 2

    gram, slope, loss = sums(weights, True)
    value = objective(loss, weights)
    losses.append(float(value.sum()))
    for _ in range(max_iter):
        step = np.linalg.solve(gram + np.diag(penalty), (slope + weights * penalty)[:, :, None])[:, :, 0]
        scale = np.ones(len(labels))
        while True:
            moved = weights - scale[:, None] * step
            gram, slope, loss = sums(moved, True)
            later = objective(loss, moved)
            worse = later > value + 1e-15
            if not worse.any() or scale.min() < 1e-6:
                break
            scale = np.where(worse, scale / 2, scale)
        gain = value.sum() - later.sum()
        if gain > 0:
            weights, value = moved, later
            losses.append(float(value.sum()))
        if gain <= tolerance:
            break
    return Probe(labels, weights, losses)


def apply_probe(df: DataFrame, probe: Probe, vec: str = "vec") -> DataFrame:
    """``df`` with ``predicted``, the label of the highest score; NULL without a vector."""
    shared = df.sparkSession.sparkContext.broadcast(probe)

    def predict(lists: pa.Array) -> pa.Array:
        known = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
        out = np.full(len(lists), None, object)
        if len(known) and shared.value.labels:
            x = _with_bias(pa.RecordBatch.from_arrays([lists.take(pa.array(known))], ["v"]))
            out[known] = np.array(shared.value.labels, object)[(x @ shared.value.weights.T).argmax(axis=1)]
        return pa.array(out.tolist(), pa.string())

    return df.withColumn("predicted", F.arrow_udf(predict, returnType="string")(F.col(vec)))


def linear_probe(
    train: DataFrame, test: DataFrame, vec: str = "vec", label: str = "label", max_iter: int = 50, ridge: float = 1e-3
) -> tuple[DataFrame, float]:
    """Logistic regression on sentence vectors: (test rows with ``predicted``, accuracy)."""
    probe = fit_probe(train, vec, label, max_iter, ridge)
    scored = apply_probe(test.filter(F.col(vec).isNotNull()), probe, vec)
    accuracy = evaluate(scored, label).first().accuracy
    return scored, 0.0 if accuracy is None else accuracy
