"""Filter interaction audit: what every filter removes at every step of every order of the filters.

A document is known by the mask of the filters it fails, so documents are counted by part and mask
first and only these counts go on. Orders are numbered as permutations in lexicographic order
(Lehmer rank). The orders that remove a mask at a given step by a given filter are those that begin
with some filters the mask passes and then that one; all orders with one beginning are neighbours,
so they are an interval of ranks. A count is added where an interval begins and taken away where it
ends, and running sums over the ranks give what each order removes at each step.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WORDS = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = "[#$%&*|]"
COUNTS = ("docs", "good", "toxic")


def orders(letters: str) -> list[str]:
    """All orders of the filters; the place in the list is the Lehmer rank."""
    return ["".join(p) for p in permutations(sorted(letters))]


def lehmer_rank(beginning: str, letters: str) -> int:
    """The rank of the first order that begins so."""
    left, rank = sorted(letters), 0
    for letter in beginning:
        place = left.index(letter)
        rank += place * factorial(len(left) - 1)
        left.pop(place)
    return rank


def removal_edges(letters: str) -> list[tuple[int, int, int, int]]:
    """(mask, step, rank, sign): where the orders that remove the mask at the step begin (1) and end (-1).

    Bit i of a mask stands for the i-th letter. Bounds where one interval ends and the next begins
    cancel and are left out.
    """
    letters = "".join(sorted(letters))
    edges: dict[tuple[int, int, int], int] = {}
    for mask in range(1, 1 << len(letters)):
        failed = [x for i, x in enumerate(letters) if mask >> i & 1]
        passed = [x for x in letters if x not in failed]
        for step in range(1, len(passed) + 2):
            for before in permutations(passed, step - 1):
                for letter in failed:
                    low = lehmer_rank("".join(before) + letter, letters)
                    for rank, sign in ((low, 1), (low + factorial(len(letters) - step), -1)):
                        edges[mask, step, rank] = edges.get((mask, step, rank), 0) + sign
    return [(*key, sign) for key, sign in edges.items() if sign]


def text_conditions(text: str) -> dict[str, Column]:
    """The failure conditions that look at one text (never NULL)."""
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals > CAPITAL_PERCENT * F.char_length(text),
        "D": F.rlike(text, F.lit(SYMBOLS)),
    }


def mask_counts(
    docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column] | None = None, copies: str = "E", text: str = "text"
) -> DataFrame:
    """(part, mask, docs, good, toxic): documents by part and by the filters they fail.

    ``conditions`` are columns over ``_text``, which is never NULL. ``copies`` names the filter that
    a document fails if its text is that of a smaller ``doc_id`` anywhere in the table (texts with
    one SHA-256 are the same text). NULL texts are empty, NULL sources are the part ''. A row without
    doc_id is never a copy, makes none and has no labels; rows that repeat doc_id and text count each,
    and are no copies of one another. Of several labels for one doc_id any that says 1 counts. Empty
    tables give no rows.
    """
    conditions = text_conditions("_text") if conditions is None else conditions
    letters = sorted([*conditions, copies])
    bit = {letter: 1 << i for i, letter in enumerate(letters)}
    mask = sum((F.when(c, bit[x]).otherwise(0) for x, c in conditions.items()), F.lit(0))
    given = docs.select(
        F.col("doc_id"),
        F.coalesce(F.col("source"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    rows = given.select("doc_id", "part", F.unhex(F.sha2("_text", 256)).alias("same"), mask.cast("int").alias("mask"))
    rows = stored(rows.groupBy("doc_id", "part", "same", "mask").agg(F.count("*").alias("docs")), "audit")
    known = rows.filter("doc_id IS NOT NULL")
    # Keys of both joins are single documents, so copies of one text never meet.
    first = known.groupBy("same").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    marks = (
        labels.select("doc_id", (F.col("quality") == 1).alias("_good"), (F.col("toxic") == 1).alias("_toxic"))
        .filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("_good").alias("_good"), F.max("_toxic").alias("_toxic"))
    )
    full = F.col("mask") + F.when(F.col("_first").isNull(), bit[copies]).otherwise(0)
    one = lambda c: F.when(F.col(c), F.col("docs")).otherwise(0)
    known = (
        known.join(first, ["same", "doc_id"], "left")
        .join(marks, "doc_id", "left")
        .select("part", full.alias("mask"), "docs", one("_good").alias("good"), one("_toxic").alias("toxic"))
    )
    nameless = rows.filter("doc_id IS NULL").select(
        "part", "mask", "docs", F.lit(0).cast("bigint").alias("good"), F.lit(0).cast("bigint").alias("toxic")
    )
    return known.unionByName(nameless).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])


def interactions(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from the counts by part and mask.

    ``kept`` is what is left after the step, ``removed`` what it removes, ``redundant`` what fails its
    filter and was removed earlier, ``unique_fails`` what fails this filter only, ``good_lost`` and
    ``toxic_lost`` the labelled ones among the removed, ``shapley`` what the filter removes in all
    orders together. Parts without failures have rows too.
    """
    letters = "".join(sorted(letters))
    every, n = orders(letters), len(letters)
    counts = stored(counts, "masks")  # at most 2 ** n rows a part
    spark = counts.sparkSession
    edges = F.broadcast(spark.createDataFrame(removal_edges(letters), "mask int, step int, rank int, sign int"))  # fixed by n
    # Ends after the last order change nothing.
    moved = counts.join(edges, "mask").filter(F.col("rank") < len(every))
    moved = moved.select("part", "step", "rank", *[(F.col("sign") * F.col(c)).alias(c) for c in COUNTS], F.lit(None).cast("bigint").alias("total"))
    cells = F.explode(F.sequence(F.lit(0), F.lit(n * len(every) - 1))).alias("_cell")
    grid = counts.groupBy("part").agg(F.sum("docs").alias("total")).select("part", "total", cells)
    nothing = [F.lit(0).cast("bigint").alias(c) for c in COUNTS]
    grid = grid.select(
        "part", (F.col("_cell") % n + 1).cast("int").alias("step"), F.floor(F.col("_cell") / n).cast("int").alias("rank"), *nothing, "total"
    )
    changes = moved.unionByName(grid).groupBy("part", "step", "rank")
    changes = changes.agg(*[F.sum(c).alias(c) for c in COUNTS], F.max("total").alias("total"))
    until = (Window.unboundedPreceding, Window.currentRow)
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(*until)
    steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(*until)
    own = Window.partitionBy("part", "_filter")
    order = F.element_at(F.array(*map(F.lit, every)), F.col("rank") + 1)
    removed = changes.select("part", "step", "rank", "total", *[F.sum(c).over(along).alias(c) for c in COUNTS])
    removed = removed.withColumn("filter_order", order).withColumn("_filter", F.substr("filter_order", F.col("step"), F.lit(1)))
    return removed.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("docs").over(steps)).alias("kept"),
        F.col("docs").alias("removed"),
        # A filter that comes first removes all that fail it, one that comes last those that fail it alone.
        (F.max("docs").over(own) - F.col("docs")).alias("redundant"),
        F.min("docs").over(own).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("docs").over(own).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters A to E over whole texts; see ``mask_counts`` and ``interactions``."""
    return interactions(mask_counts(docs, labels), "ABCDE")
