"""Documents whose sets of word n-grams are alike: a grouped prefix join, and its components.

Two sets whose Jaccard similarity reaches the threshold share an element among the first few of each,
in any order fixed for all elements; with rare elements first, few other sets share those. The order
comes from a count sketch of fixed size over all documents: frequent elements go last.

Documents with the same set form a class, classes with the same prefix and size a group. Only groups
meet: pairs that share a prefix element are filtered by size, by the places of what they share and by
bitmaps of their sets, then expanded to classes and verified on the texts.

Links are looked for in two passes. The first pairs every group with two likely partners, so that
large families of near copies come together with as many pairs as members. The second takes every
pair left between different components, so that no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components

SKETCH_BITS = 21  # two rows of 2^21 counters, 16 MB, whatever the corpus
CHUNK = 1 << 16
SIGNATURE_BITS = 1024
MAX_WORDS = 200_000  # of a task's table of word hashes, which then starts anew
_B = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of hashed word n-grams; A-Z are read as a-z, fewer than n words make one shingle."""

    def __init__(self, n: int):
        self.n = n
        self.known: dict[bytes, int] = {}

    def shingles(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes."""
        words = (text or b"").lower().split()  # of bytes: ASCII letters and white space only
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > MAX_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.n, len(words))
        out = hashes[: len(hashes) - size + 1].copy()
        for i in range(1, size):
            out = _mix(out * _B + hashes[i : len(hashes) - size + 1 + i])
        return np.unique(_mix(out + np.uint64(size)))


def _counters(h: np.ndarray) -> np.ndarray:
    """The element's counter in each of the two rows of the sketch."""
    mask = np.uint64((1 << SKETCH_BITS) - 1)
    return np.stack([h & mask, (h >> np.uint64(SKETCH_BITS)) & mask]).astype(np.int64)


def sketch(rows: DataFrame, elements) -> np.ndarray:
    """Counts of all elements in a sketch of fixed size.

    ``elements`` gives the hashes in a batch of ``rows``. Each task counts its own rows; the chunks of
    these counts meet by number and are added up one by one.
    """
    width, most = 1 << SKETCH_BITS, np.iinfo(np.int32).max

    def packed(number: int, counts: np.ndarray) -> pa.RecordBatch:
        data = pa.Codec("zstd").compress(counts.astype(np.int32).tobytes(), asbytes=True)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([data], pa.binary())], ["chunk", "counts"])

    def unpacked(data: bytes) -> np.ndarray:
        raw = pa.Codec("zstd").decompress(data, decompressed_size=4 * CHUNK, asbytes=True)
        return np.frombuffer(raw, np.int32).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * width, np.int32)
        for batch in batches:
            for h in elements(batch):
                at = _counters(h)
                total[:width] += np.bincount(at[0], minlength=width).astype(np.int32)
                total[width:] += np.bincount(at[1], minlength=width).astype(np.int32)
        if not total.any():
            return
        chunks = total.reshape(-1, CHUNK)
        for number in np.flatnonzero(chunks.any(axis=1)).tolist():
            yield packed(number, chunks[number])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[number] = np.minimum(sums.get(number, 0) + unpacked(counts), most)
        for number, counts in sums.items():
            yield packed(number, counts)

    schema = "chunk int, counts binary"
    parts = rows.mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema)
    total = np.zeros((2 * width // CHUNK, CHUNK), np.int32)
    for row in parts.toLocalIterator():  # of fixed size
        total[row["chunk"]] = unpacked(row["counts"])
    return total.reshape(2, width)


def needed(n: Column, m: Column, percent: int) -> Column:
    """Shared elements that sets of n and m elements need: the least i with i >= percent % of the union."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100.0 + percent))


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _signed(x) -> int:
    return int(np.uint64(x).astype(np.int64))


def summaries(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, text_hash, n, set and prefix checksums, prefix, signature.

    ``signature`` holds, for each of 1024 buckets of hashes, whether an odd number of elements fall
    into it: sets differ in at least as many elements as signatures in bits.
    """

    def elements(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        shingler = Shingler(n)
        held, size = [], 0
        for text in batch.column(0).cast(pa.binary()):
            held.append(shingler.shingles(text.as_py()))
            size += len(held[-1])
            if size > 1 << 21:
                yield np.concatenate(held)
                held, size = [], 0
        if held:
            yield np.concatenate(held)

    counts = docs.sparkSession.sparkContext.broadcast(sketch(docs.select("text"), elements))  # 16 MB

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, table = Shingler(n), counts.value
        for batch in batches:
            for low in range(0, len(batch), 1024):
                part = batch.slice(low, 1024)
                numbers, prefixes, signatures = [], [], []
                for text in part.column("text").cast(pa.binary()):
                    h = shingler.shingles(text.as_py())
                    at = _counters(h)
                    often = np.minimum(table[0][at[0]], table[1][at[1]])
                    prefix = h[np.lexsort((h, often))][: _prefix_size(len(h), percent)] if len(h) else h
                    odd = np.bincount((h >> np.uint64(44)).astype(np.int64) & (SIGNATURE_BITS - 1), minlength=SIGNATURE_BITS) & 1
                    sums = [x.sum(dtype=np.uint64) for x in (h, _mix(h * _B), _mix(prefix), _mix(prefix * _B))]
                    numbers.append([len(h), *map(_signed, sums)])
                    prefixes.append(prefix.astype(np.int64))
                    signatures.append(np.packbits(odd.astype(bool)).view(np.int64))
                values = np.array(numbers, np.int64).reshape(len(part), 5)
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.array(np.concatenate([*x, np.zeros(0, np.int64)]))
                    )
                    for x in (prefixes, signatures)
                ]
                columns = [part.column("doc_id"), part.column("text_hash"), *[pa.array(values[:, i]) for i in range(5)], *lists]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in fields])

    key_type = docs.schema["doc_id"].dataType.simpleString()
    fields = [f"doc_id {key_type}", "text_hash bigint", "n bigint", "c1 bigint", "c2 bigint", "p1 bigint", "p2 bigint"]
    fields += ["prefix array<bigint>", "signature array<bigint>"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(summarise, ", ".join(fields))


def _neighbours(elements: DataFrame) -> DataFrame:
    """Rows whose element occurs again, with the group before them at the same element.

    Rows are sorted by range, so an element that very many groups share spans many tasks; where a
    task begins, a row has no group before it, which the first pass can do without.
    """
    ranged = elements.repartitionByRange("element", "n", "gid").sortWithinPartitions("element", "n", "gid")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far
        before = None  # and the row before it
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([b for b in (held, batch) if b is not None]).combine_chunks().to_batches()[0]
            out = _marked(table, before, last=False)
            before = table.slice(len(table) - 2, 1) if len(table) > 1 else before
            held = table.slice(len(table) - 1)
            yield out
        if held is not None:
            yield _marked(held, before, last=True)

    def _marked(table: pa.RecordBatch, before: pa.RecordBatch | None, last: bool) -> pa.RecordBatch:
        """The rows of ``table``, but for its last one unless ``last``, that share an element."""
        element, gid = table.column("element").to_numpy(), table.column("gid").to_numpy()
        first = before is not None and before.column("element")[0].as_py() == element[0]
        same = np.concatenate([[first], element[1:] == element[:-1]])
        previous = np.concatenate([[before.column("gid")[0].as_py() if first else -1], gid[:-1]])
        previous = np.where(same, previous, -1)
        follows = np.concatenate([same[1:], [True]])
        if before is None:
            follows[0] = True  # another task may hold the rows before it
        keep = same | follows
        if not last:
            keep[-1] = False
        rows = table.filter(pa.array(keep))
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(previous[keep], pa.int64())], [*rows.schema.names, "previous"])

    return ranged.mapInArrow(mark, "element bigint, gid bigint, n bigint, pos int, previous bigint")


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


class _Verifier:
    """Checks pairs of classes on the texts."""

    def __init__(self, docs: DataFrame, classes: DataFrame, n: int, percent: int):
        self.docs, self.classes, self.n, self.percent = docs, classes, n, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold."""
        percent, n = self.percent, self.n
        left = self.classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"), F.col("text_hash").alias("ta"))
        right = self.classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"), F.col("text_hash").alias("tb"))
        differ = F.aggregate(
            F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x
        )
        na, nb = F.col("na"), F.col("nb")
        may = _sizes_fit(na, nb, percent) & (differ <= na + nb - 2 * needed(na, nb, percent))
        pairs = stored(pairs.join(left, "a").join(right, "b").filter(may).select("a", "b", "ta", "tb"), "pairs")

        wanted = pairs.selectExpr("a AS cid", "ta AS text_hash").union(pairs.select("b", "tb")).distinct()
        texts = stored(self._texts(stored(wanted, "wanted")), "pair-texts")

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingler = Shingler(n)
            for batch in batches:
                one = None
                keep = []
                sides = (batch.column("text_a").cast(pa.binary()), batch.column("text_b").cast(pa.binary()))
                for row, a in enumerate(batch.column("a").to_pylist()):
                    if one is None or one[0] != a:
                        one = (a, shingler.shingles(sides[0][row].as_py()))
                    x, y = one[1], shingler.shingles(sides[1][row].as_py())
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        sides = pairs.select("a", "b").join(texts.withColumnsRenamed({"cid": "a", "text": "text_a"}), "a")
        sides = sides.join(texts.withColumnsRenamed({"cid": "b", "text": "text_b"}), "b")
        return stored(sides.mapInArrow(verify, "a bigint, b bigint"), "links")

    def _texts(self, wanted: DataFrame) -> DataFrame:
        """(cid, text) of the wanted (cid, text_hash), once each.

        A sketch of the wanted hashes, of fixed size, drops most other texts before anything is
        shuffled; copies of a text leave each task once, and the join leaves one of them.
        """
        columns = lambda batch: [batch.column(0).to_numpy().view(np.uint64)]
        some = self.docs.sparkSession.sparkContext.broadcast(np.packbits(sketch(wanted.select("text_hash"), columns) > 0, axis=1))

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                hashes = batch.column("text_hash").to_numpy()
                at = _counters(hashes.view(np.uint64))
                flags = np.logical_and(*[(some.value[i][at[i] >> 3] >> (7 - (at[i] & 7))) & 1 for i in (0, 1)])
                keep = []
                for flag, h in zip(flags.tolist(), hashes.tolist(), strict=True):
                    keep.append(flag and h not in seen)
                    if flag:
                        seen.add(h)
                yield batch.filter(pa.array(keep, pa.bool_()))

        rows = self.docs.select(F.xxhash64("text").alias("text_hash"), "text")
        found = rows.mapInArrow(pick, "text_hash bigint, text string").join(wanted, "text_hash")
        return found.dropDuplicates(["text_hash", "cid"]).select("cid", "text")


def _likely(shared: DataFrame) -> DataFrame:
    """Up to two partners (a, b) for every group: of the groups before it, and of the leaders, at its
    prefix elements, the one met most often.

    An element's leader is the group whose own elements are shared most widely: in a family of edited
    copies, one with few edits, which most others resemble.
    """
    before = shared.filter("previous >= 0 and previous <> gid").select("gid", F.col("previous").alias("other"))
    runs = shared.groupBy("element").agg(F.count("*").alias("k"))
    spread = shared.join(runs, "element").groupBy("gid").agg(F.sum("k").alias("spread"))
    leaders = shared.select("element", "gid").join(spread, "gid").groupBy("element")
    leaders = leaders.agg(F.max(F.struct("spread", F.col("gid").alias("other"))).alias("_best")).select("element", "_best.other")
    led = shared.select("element", "gid").join(leaders, "element").filter("gid <> other").select("gid", "other")
    found = None
    for pairs in (before, led):
        best = pairs.groupBy("gid", "other").count().groupBy("gid").agg(F.max(F.struct("count", "other")).alias("best"))
        best = best.selectExpr("least(gid, best.other) AS a", "greatest(gid, best.other) AS b")
        found = best if found is None else found.union(best)
    return found.distinct()


def _crossing(shared: DataFrame, members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes (a, b) from different components whose groups share a prefix element.

    ``shared``: element, gid, n, pos; ``members``: gid, cid, size, comp. Elements met by one component
    alone go at once. At the others, groups outside the element's largest component meet all groups,
    so that this component never meets itself, and sizes, places and folded signatures are compared
    as they meet.
    """
    words = SIGNATURE_BITS // 128
    fold = [F.get("signature", i).bitwiseXOR(F.get("signature", i + words)).alias(f"s{i}") for i in range(words)]
    alone = members.filter("size = 1").select("cid")
    signatures = classes.join(alone, "cid", "left_semi").select(F.col("cid").alias("gid"), *fold)
    rows = shared.select("element", "gid", "n", "pos").join(members.select("gid", "comp").distinct(), "gid")
    sizes = rows.groupBy("element", "comp").agg(F.count("*").alias("k")).groupBy("element")
    mixed = sizes.agg(F.max(F.struct("k", "comp")).alias("most"), F.count("*").alias("comps")).filter("comps > 1")
    rows = rows.join(mixed.select("element", F.col("most.comp").alias("most")), "element")
    rows = rows.withColumn("outside", F.col("comp") != F.col("most")).drop("most")
    rows = stored(rows.join(signatures, "gid", "left"), "crossing")

    x, y = rows.filter("outside").alias("x"), rows.alias("y")
    one, two = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    least = needed(one("n"), two("n"), percent)
    rest = F.least(one("n") - one("pos") - 1, two("n") - two("pos") - 1)
    differ = sum((F.bit_count(one(f"s{i}").bitwiseXOR(two(f"s{i}"))) for i in range(words)), F.lit(0))
    meet = (
        (one("element") == two("element"))
        & (one("comp") != two("comp"))
        & (~two("outside") | (one("gid") < two("gid")))
        & (one("gid") != two("gid"))
        & _sizes_fit(one("n"), two("n"), percent)
        & (F.least(one("pos"), two("pos")) + 1 + rest >= least)
        # unknown for groups of several classes, which the verifier compares one by one
        & F.coalesce(differ <= one("n") + two("n") - 2 * least, F.lit(True))
    )
    # Which side is outside changes with the element, so a pair is put in order before it is counted.
    ordered = one("gid") < two("gid")
    sides = (("x", one, two), ("y", two, one))
    found = (
        x.join(y, meet)
        .select(
            *[F.when(ordered, a(c)).otherwise(b(c)).alias(f"{c}_{side}") for side, a, b in sides for c in ("gid", "n", "pos")]
        )
        .groupBy("gid_x", "gid_y", "n_x", "n_y")
        .agg(F.count("*").alias("common"), F.max("pos_x").alias("pos_x"), F.max("pos_y").alias("pos_y"))
    )
    # No later element of either prefix is shared, so the rest is bounded by what lies behind.
    behind = F.least(F.col("n_x") - F.col("pos_x") - 1, F.col("n_y") - F.col("pos_y") - 1)
    found = found.filter(F.col("common") + behind >= needed(F.col("n_x"), F.col("n_y"), percent))
    split = members.groupBy("gid").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
    groups = found.selectExpr("gid_x AS ga", "gid_y AS gb").union(split.selectExpr("gid AS ga", "gid AS gb"))
    left = members.selectExpr("gid AS ga", "cid AS a", "comp AS x")
    right = members.selectExpr("gid AS gb", "cid AS b", "comp AS y")
    return (
        groups.join(left, "ga").join(right, "gb").filter("x <> y")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def similar_documents(
    docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, component, component_id.

    Two rows are linked when ``100 * intersection >= percent * union`` of their sets of ``words``-word
    shingles; ``component_id`` is the smallest key that links reach, the row's own included. NULL
    and wordless texts have empty sets and no links. Rows that repeat a key are compared as rows of
    their own; a NULL key is the component's only if no row of it has another. Keys are whole numbers.
    """
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = stored(summaries(docs, words, percent), "summaries")
    classes = (
        rows.filter("n > 0")
        .groupBy("n", "c1", "c2", "p1", "p2")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min("text_hash").alias("text_hash"),
            F.first("prefix").alias("prefix"),
            F.first("signature").alias("signature"),
        )
    )
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    # A group is named by its smallest class, which also lends it its prefix.
    groups = classes.groupBy("n", "p1", "p2").agg(F.min("cid").alias("gid"), F.count("*").alias("size"))
    members = stored(classes.select("cid", "n", "p1", "p2").join(groups, ["n", "p1", "p2"]).select("gid", "cid", "size"), "members")
    followers = stored(members.filter("gid <> cid").select("cid"), "followers")  # few, so prefixes stay where they are
    elements = classes.join(followers, "cid", "left_anti").select(
        F.col("cid").alias("gid"), "n", F.posexplode("prefix").alias("pos", "element")
    )
    shared = stored(_neighbours(elements.select("element", "gid", "n", "pos")), "shared")
    verifier = _Verifier(docs, classes, words, percent)

    first = _likely(shared).union(members.filter("cid <> gid").selectExpr("gid AS a", "cid AS b"))
    links = verifier.links(first)
    labels = components(links)

    placed = _placed(members, labels)
    more = verifier.links(_crossing(shared, stored(placed.select("gid", "cid", "size", "comp"), "placed"), classes, percent))
    labels = components(links.union(more))
    placed = stored(_placed(members, labels).select("cid", "comp"), "placed")

    named = classes.select("cid", "n", "c1", "c2", "least_id").join(placed, "cid")
    ids = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    named = named.join(ids, "comp").select("n", "c1", "c2", F.col("comp").alias("component"), "component_id")
    return rows.select("doc_id", "text_hash", "n", "c1", "c2").join(named, ["n", "c1", "c2"], "left").select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component of :func:`similar_documents`: that of the smallest key.

    Among rows that share it, the smallest hash of the text stays, and of rows equal in key and text
    the smallest by their other columns (any of them where these have no order). A NULL key stays only
    where its component has no other. Texts without words stay.
    """
    found = stored(similar_documents(docs, words, percent, key, text).filter("component is not null"), "components")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = found.groupBy("component").agg(F.min(order).alias("best"))
    gone = found.join(best, "component").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash")))
    )
    gone = gone.select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_hash")).distinct()
    gone = stored(gone, "near-copies")
    own_key, own_hash = F.col(f"`{key}`").cast("bigint"), F.xxhash64(F.col(f"`{text}`"))
    same = own_key.eqNullSafe(F.col("_gone")) & (own_hash == F.col("_gone_hash"))
    kept = docs.join(gone, same, "left_anti")
    repeated = found.groupBy(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_hash")).count().filter("count > 1").drop("count")
    repeated = stored(repeated, "repeated")
    if not repeated.limit(1).count():
        return kept
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = F.struct(*columns)
    ordered = not any(kind in docs.schema.simpleString() for kind in ("map<", "variant", "interval"))
    # The rows of one key and text combine before they meet.
    one = kept.join(repeated, same, "left_semi").groupBy(own_key, own_hash).agg((F.min if ordered else F.first)(row).alias("_row"))
    single = kept.join(repeated, same, "left_anti")
    return single.unionByName(one.select("_row.*"))


def _placed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component: the label of their class, or the class alone."""
    labels = labels.withColumnRenamed("node", "cid")
    return members.join(labels, "cid", "left").withColumn("comp", F.coalesce("label", "cid"))
