"""Secret scans over a trigram inverted index.

Every rule is a regular expression. From its parse tree follows a Boolean query over trigrams: an OR
of ANDs, one for each literal that a match may contain; a rule without a mandatory trigram has no
query and scans every text. The index holds a posting (trigram, document) for each trigram that some
rule asks for. Postings that meet every trigram of a literal make a document a candidate of the rule,
and only candidates are searched with the expression itself.

Everything on the data path is DataFrame expressions; only rules are parsed in Python.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_LITERALS = 64  # alternatives kept while a literal grows; beyond it the literal is closed


@dataclass(frozen=True)
class Rule:
    """``pattern`` is written in the common part of Java's and Python's syntax, as ``(text)``.

    A match counts if ``group`` has at least ``least`` characters. ``probe`` finds, as a cheaper
    test, any text that has such a match.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    probe: str | None = None


# The contract's kinds in its order, then published token formats.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32, r"[0-9a-f]{32}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
    Rule("bearer", r"(?i:bearer)\x20+([A-Za-z0-9+/_.=-]+)", 1, 20),
)
RULES = BASE_RULES + MORE_RULES


# ---- rules to Boolean trigram queries -------------------------------------------------------------


def _fold(ch: int) -> str:
    return chr(ch).lower() if ch < 128 else chr(ch)


def _and(a: list[frozenset], b: list[frozenset]) -> list[frozenset]:
    return list({x | y for x in a for y in b})


def _close(literals: set[str]) -> list[frozenset]:
    """The query that one of ``literals`` occurs; too short a literal asks for nothing."""
    return list({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in literals})


def _walk(items, literals: set[str]) -> tuple[list[frozenset], set[str]]:
    """(query so far, texts that a match may end with) after ``items``, begun with ``literals``."""
    query = [frozenset()]

    def extend(options: set[str] | None):
        nonlocal query, literals
        grown = {a + b for a, b in itertools.product(literals, options)} if options else None
        if grown is None or len(grown) > MAX_LITERALS:
            query = _and(query, _close(literals))
            literals = options if options and len(options) <= MAX_LITERALS else {""}
        else:
            literals = grown

    for op, value in items:
        if op is sre.LITERAL:
            extend({_fold(value)})
        elif op is sre.IN:
            chars: set[str] | None = set()
            for kind, part in value:
                if kind is sre.LITERAL:
                    chars.add(_fold(part))
                elif kind is sre.RANGE and part[1] - part[0] < 8:
                    chars.update(map(_fold, range(part[0], part[1] + 1)))
                else:
                    chars = None
                    break
            extend(chars)
        elif op is sre.SUBPATTERN:
            inner, ends = _walk(value[3], set(literals))
            query, literals = _and(query, inner), ends
        elif op is sre.BRANCH:
            queries, ends = [], set()
            for branch in value[1]:
                inner, last = _walk(branch, set(literals))
                queries += inner
                ends |= last
            query, literals = _and(query, list(set(queries))), ends
        elif op is sre.MAX_REPEAT and value[:2] == (0, 1):
            inner, ends = _walk(value[2], set(literals))
            literals |= ends if inner == [frozenset()] else set()
            if inner != [frozenset()]:
                query, literals = _and(query, _close(literals)), {""}
        elif op is sre.MAX_REPEAT:
            query = _and(query, _close(literals))
            if value[0] > 0:
                inner, ends = _walk(value[2], {""})
                query = _and(query, _and(inner, _close(ends)))
            literals = {""}
        elif op is not sre.AT:
            extend(None)
    return query, literals


def trigram_query(pattern: str) -> list[frozenset]:
    """An OR of ANDs over lower-case trigrams that every match of ``pattern`` meets; [] asks for a full scan."""
    query, literals = _walk(_parser.parse(pattern), {""})
    query = _and(query, _close(literals))
    smallest = [q for q in query if not any(other < q for other in query)]
    return [] if frozenset() in smallest else sorted(smallest, key=sorted)


# ---- index ---------------------------------------------------------------------------------------


def build_index(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (trigram, doc): the trigrams of the rules' queries, and the hashed keys of the rows that hold them.

    Texts are folded to lower case. Rows that share a key share their postings; NULL texts have none.
    """
    trigrams = sorted({t for r in rules for clause in trigram_query(r.pattern) for t in clause})
    table = F.array(*map(F.lit, trigrams)) if trigrams else F.array().cast("array<string>")
    # The one-element array binds the folded text, so that it is made once for all trigrams.
    found = F.transform(
        F.array(F.lower(F.col(text))), lambda low: F.filter(table, lambda t: F.contains(low, t))
    )[0]
    return docs.select(F.xxhash64(F.col(key)).alias("doc"), F.explode_outer(found).alias("trigram")).filter(
        "trigram is not null"
    )


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows (doc, kinds): the rules whose trigram query the postings of a document meet."""
    spark = index.sparkSession
    clauses = [
        (r.kind, number, trigram, 1 << bit, (1 << len(clause)) - 1)
        for r in rules
        for number, clause in enumerate(trigram_query(r.pattern))
        for bit, trigram in enumerate(sorted(clause))
    ]
    schema = "kind string, clause int, trigram string, bit bigint, full bigint"
    table = F.broadcast(spark.createDataFrame(clauses, schema))  # as large as the rules
    met = (
        index.join(table, "trigram")
        .groupBy("doc", "kind", "clause")
        .agg(F.bit_or("bit").alias("bits"), F.first("full").alias("full"))
        .filter("bits = full")
    )
    return met.groupBy("doc").agg(F.collect_set("kind").alias("kinds"))  # at most one entry per rule


# ---- verification --------------------------------------------------------------------------------


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """Array of (start, place, end) of the rule's matches, in code points.

    The pieces between the matches and the matches themselves take turns, so running sums of their
    lengths are the positions.
    """
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("all"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("part"),
    )
    empty = F.array().cast("array<struct<start:bigint,place:int,end:bigint>>")
    state = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["all"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"))
        kept = F.when(x["part"] >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    return F.aggregate(parts, state, step, lambda acc: acc["spans"])


def _joined(spans: Column, rules: Sequence[Rule]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", kinds[s["place"]], s["start"], s["end"])), ","
    )


def scan_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, hits, spans.

    ``hits`` is an array of (start, place, end), ordered by start, then place, the rule's number;
    ``spans`` writes them as kind:start:end, joined by commas; positions are code points, ends
    exclusive. Matches of a rule are leftmost and do not overlap; spans of different rules may.
    NULL texts count as empty and have none; NULL and repeated keys are rows like any other.
    """
    indexed = [r for r in rules if trigram_query(r.pattern)]
    found = stored(candidates(build_index(docs, rules, key, text), indexed), "secret-candidates")
    rows = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(F.col(key)).alias("doc")
    ).join(found, "doc", "left")
    none = F.array().cast("array<struct<start:bigint,place:int,end:bigint>>")
    columns = []
    for place, rule in enumerate(rules):
        test = F.array_contains("kinds", rule.kind) if rule in indexed else F.col("text").rlike(rule.probe or rule.pattern)
        columns.append(F.when(test, _spans(F.col("text"), rule, place)).otherwise(none))
    hits = F.array_sort(F.concat(*columns))
    return rows.select("doc_id", hits.alias("hits")).withColumn("spans", _joined(F.col("hits"), rules))


def digest(found: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """Counts and a checksum of the first ``base`` rules' spans, and all spans."""
    own = F.filter("hits", lambda s: s["place"] < len(base))
    places = F.col("hits.place")
    counts = [
        (F.size(places) - F.size(F.array_remove(places, place))).cast("bigint").alias(f"n_{rule.kind}")
        for place, rule in enumerate(base)
    ]
    return found.select("doc_id", *counts, F.sha2(_joined(own, rules), 256).alias("base_sha256"), "spans")
