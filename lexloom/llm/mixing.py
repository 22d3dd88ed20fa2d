"""Mixing sources to target weights by Sainte-Laguë apportionment.

Each source has a target of words: weights share the whole, and no target exceeds ``limit`` times
what the source holds. Words are laid out in shards, each (source, shard) cell in a seeded order of
its documents, and cut into blocks of equal token counts. Highest quotients ``votes / (2 seats + 1)``
give every source, then every shard of a source, a whole number of blocks; a cell then takes full
rounds of its blocks and the rest as a run of blocks from a seeded place. Only the two documents at
the ends of a run are taken in part.

Quotients are not listed seat by seat: a cell with the share p of the seats gets between
``round(p (1 - c / 2H))`` and ``round(p (1 + c / 2H))`` of H seats among c cells, so only the seats
between these bounds compete, about two for each cell whatever the number of blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import positions, seeded, stored, words_of

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 16
SHARDS = 8
SEED = 17


def water_levels(sizes: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """Targets of sources. ``sizes``: source, source_size. Adds rank (from 0), weight and target.

    Sources in order of code points, NULL last, weigh ``weights``, repeating. Targets sum to
    ``share`` of all words; a target above ``limit`` times its source's size is cut to that, and
    the excess goes to the others by weight until none is above. One row per source.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.get(cycle, F.col("rank") % len(weights)))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(limit)))
    # With the caps in the order in which they are reached, the level that uses up the whole after
    # the first k caps is (whole - caps) / remaining weights: it rises up to the solution, the first
    # that reaches no further cap, and falls from there.
    reached = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = reached.rowsBetween(Window.unboundedPreceding, -1)
    after = reached.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    steps = ranked.withColumn("level", level).withColumn("fits", F.col("level") <= F.col("cap") / F.col("weight"))
    chosen = F.max(F.when(F.col("fits"), F.col("level"))).over(everything)
    target = F.when(chosen.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), chosen * F.col("weight")))
    return steps.select("source", "source_size", "rank", "weight", target.alias("target"))


def apportion(cells: DataFrame, keys: Sequence[str], group: Sequence[str], votes: str, seats: str) -> DataFrame:
    """Sainte-Laguë seats of every cell: adds ``quota``.

    ``seats`` is the group's number of seats, ``votes`` the cell's non-negative claim. Seats go to
    the highest quotients; equal quotients to the smaller keys. ``keys`` tell the cells of a group apart.
    """
    whole = Window.partitionBy(*group)
    p = F.col(seats) * F.col(votes) / F.sum(votes).over(whole)
    half = F.count("*").over(whole) / (2.0 * F.col(seats))
    cells = cells.withColumn("_p", F.coalesce(F.when(F.col(seats) > 0, p), F.lit(0.0)))
    cells = cells.withColumn("_half", F.coalesce(F.when(F.col(seats) > 0, half), F.lit(0.0)))
    # One seat of slack on either side, for rounding.
    low = F.greatest(F.lit(0), F.floor(F.col("_p") * (1 - F.col("_half")) + 0.5) - 1).cast("bigint")
    high = F.when(F.col("_p") > 0, F.floor(F.col("_p") * (1 + F.col("_half")) + 0.5) + 1).otherwise(low)
    cells = cells.withColumn("_low", low).withColumn("_high", high.cast("bigint"))
    cells = cells.withColumn("_free", F.col(seats) - F.sum("_low").over(whole))
    contested = (
        cells.filter("_high > _low")
        .select(*group, *keys, votes, "_free", F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_seat"))
        .withColumn("_quotient", F.col(votes) / (2.0 * F.col("_seat") + 1.0))
    )
    by_quotient = Window.partitionBy(*group).orderBy(F.col("_quotient").desc(), *keys)
    won = (
        contested.withColumn("_place", F.row_number().over(by_quotient))
        .filter("_place <= _free")
        .groupBy(*group, *keys)
        .agg(F.count("*").alias("_won"))
    )
    return (
        cells.join(won, [*group, *keys], "left")
        .withColumn("quota", F.col("_low") + F.coalesce("_won", F.lit(0)))
        .drop("_p", "_half", "_low", "_high", "_free", "_won")
    )


def _overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    limit: float = 2.0,
    block: int = BLOCK,
    shards: int = SHARDS,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: doc_id, text_hash, size, source, source_size, target, rounds, head_from, head_to,
    tail_from, tail_to, taken.

    ``size`` is the number of words. A document is taken ``rounds`` times whole, and once more the
    words [head_from, head_to) and [tail_from, tail_to) (the run of a cell may wrap around); ``taken`` is
    the sum. NULL texts and texts without words have size 0 and are never taken; a NULL source is a
    source; rows repeated in all columns are documents of their own. No words at all: targets of 0.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.expr(words_of(f"`{text}`")).cast("bigint").alias("size"),
        F.md5(F.col(text).cast("binary")).alias("text_hash"),
    )
    rows = rows.withColumn("order", seeded(seed, "doc_id", "text_hash"))
    rows = stored(rows.withColumn("shard", F.pmod("order", F.lit(shards)).cast("int")), "mix-sizes")
    words = rows.groupBy("source", "shard").agg(F.sum("size").alias("cell_size"))
    words = words.withColumn("source_size", F.sum("cell_size").over(Window.partitionBy("source")))
    words = stored(words, "mix-words")  # a row per source and shard

    levels = water_levels(words.select("source", "source_size").distinct(), weights, share, limit)
    levels = levels.withColumn("blocks", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("bigint"))
    sources = apportion(levels, ["rank"], [], "target", "blocks").withColumnRenamed("quota", "source_blocks")
    sources = stored(sources.select("source", "rank", "target", "source_blocks"), "mix-sources")

    cells = words.join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    cells = apportion(cells, ["shard"], ["rank"], "cell_size", "source_blocks")
    n_blocks = F.ceil(F.col("cell_size") / block)
    cells = (
        cells.withColumn("n_blocks", n_blocks)
        .withColumn("quota", F.least("quota", (F.col("n_blocks") * int(limit)).cast("bigint")))
        .withColumn("rounds", F.when(F.col("n_blocks") > 0, F.floor(F.col("quota") / F.col("n_blocks"))).otherwise(0))
        .withColumn("run", F.col("quota") - F.col("rounds") * F.col("n_blocks"))
        .withColumn("from_block", F.pmod(seeded(seed, "rank", "shard"), F.greatest("n_blocks", F.lit(1))))
        .withColumn("run_from", F.col("from_block") * block)
        .withColumn("run_to", F.least(F.col("cell_size"), (F.col("from_block") + F.col("run")) * block))
        .withColumn("wrap_to", F.greatest(F.lit(0), F.col("from_block") + F.col("run") - F.col("n_blocks")) * block)
    )
    # A cell is named by its source and shard; NULL sources are told from empty ones by a flag.
    name = F.xxhash64(F.col("source").isNull(), "source", "shard").alias("cell")
    cells = stored(cells.select(name, "source_size", "target", "rounds", "run_from", "run_to", "wrap_to"), "mix-cells")

    placed = positions(
        rows.withColumn("cell", name), ["cell"], ["order", "doc_id", "text_hash", "size"], "mix-order", "size", "start", cells
    )
    end = F.col("start") + F.col("size")
    inside = lambda c: F.least(F.greatest(c - F.col("start"), F.lit(0)), F.col("size")).cast("bigint")
    placed = (
        placed.withColumn("tail_from", inside(F.col("run_from")))
        .withColumn("tail_to", F.greatest("tail_from", inside(F.col("run_to"))))
        .withColumn("head_from", F.lit(0).cast("bigint"))
        .withColumn("head_to", inside(F.col("wrap_to")))
    )
    taken = (
        F.col("rounds") * F.col("size")
        + F.col("head_to")
        + _overlap(F.col("start"), end, F.col("run_from"), F.col("run_to"))
    )
    return placed.select(
        "doc_id", "text_hash", "size", "source", "source_size", "target",
        F.col("rounds").cast("bigint").alias("rounds"),
        "head_from", "head_to", "tail_from", "tail_to", taken.cast("bigint").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **parameters
) -> DataFrame:
    """The mix itself: ``docs`` with a row for every whole copy that :func:`mix` takes, and for every passage.

    Passages are the words taken from a document at the end of a run, with the white space between
    them; a passage that holds all words is a whole copy. Columns are those of ``docs``, a column
    ``n_chars`` is counted anew. Documents that are not taken are left out; rows that are equal in
    key, source and text each bring their own copies.
    """
    plan = mix(docs, key=key, text=text, source=source, **parameters).filter("taken > 0")
    names = {"doc_id": "_id", "source": "_source", "text_hash": "_hash"}
    plan = plan.select(*[F.col(c).alias(n) for c, n in names.items()], "size", "rounds", "head_to", "tail_from", "tail_to")
    plan = _numbered(stored(plan, "mix-plan"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(f"`{key}`").alias("_id"),
        F.col(f"`{source}`").cast("string").alias("_source"),
        F.md5(F.col(f"`{text}`").cast("binary")).alias("_hash"),
    )
    rows = _numbered(rows)
    joined = rows.join(plan.drop("_id", "_source", "_hash"), ["_name", "_name2", "_copy"])
    words = F.regexp_extract_all(F.col("_row").getField(text), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    passage = lambda low, high: F.rtrim(F.array_join(F.slice(words, low.cast("int") + 1, (high - low).cast("int")), ""))
    whole = F.col("_row").getField(text)
    zero = F.lit(0)
    all_words = (F.col("head_to") >= F.col("tail_from")) & (F.greatest("head_to", "tail_to") >= F.col("size"))
    parts = F.when(all_words, F.array(whole)).otherwise(
        F.concat(
            F.when(F.col("head_to") > 0, F.array(passage(zero, F.col("head_to")))).otherwise(F.array().cast("array<string>")),
            F.when(F.col("tail_to") > F.col("tail_from"), F.array(passage(F.col("tail_from"), F.col("tail_to")))).otherwise(
                F.array().cast("array<string>")
            ),
        )
    )
    texts = F.concat(F.array_repeat(whole, F.col("rounds").cast("int")), parts)
    taken = joined.select("_row", F.explode(texts).alias("_taken"))

    def column(c: str) -> Column:
        if c == text:
            return F.col("_taken").alias(c)
        value = F.length("_taken").cast(docs.schema[c].dataType) if c == "n_chars" else F.col("_row").getField(c)
        return value.alias(c)

    return taken.select(*[column(c) for c in docs.columns])


def _numbered(rows: DataFrame) -> DataFrame:
    """Name rows by two hashes of key, source and text, and number those with equal names."""
    parts = ["_id", "_source", "_hash"]
    rows = rows.withColumn("_name", F.xxhash64(*parts)).withColumn("_name2", F.xxhash64(F.lit(1), *parts))
    return rows.withColumn("_copy", F.row_number().over(Window.partitionBy("_name", "_name2").orderBy("_name")))
