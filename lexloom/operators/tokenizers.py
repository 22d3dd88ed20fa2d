"""Tokenizers by name, dictionary tokens with tags, the score-based splitter, ids.

Work that depends on a token alone is done once per distinct token; ``lookup`` carries the result
back to the lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import unnest
from ..functions.hangul import normalize_repeats, to_jamo
from ..session import measured
from .lookup import MORPHS, lookup, per_distinct

LINE_KEYS = ("doc_id", "line_no")
UNKNOWN_TAG = "UNK"

_REGISTRY: dict[str, Callable[[DataFrame, str, str, bool], DataFrame]] = {}
DEFAULT_TOKENIZER = "words"


def register_expression(name: str, fn: Callable[[Column], Column]) -> None:
    """A tokenizer that is a column expression from line to ``array<string>``."""
    _REGISTRY[name] = lambda df, col, out, pos: df.withColumn(out, fn(F.col(col)))


def register_analyzer(name: str, factory: Callable[[], object]) -> None:
    """A Python analyzer with ``morphs(text)`` and ``pos(text)``; one instance per task."""

    def apply(df: DataFrame, col: str, out: str, pos: bool) -> DataFrame:
        @F.pandas_udf("array<string>")
        def analyze(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            analyzer = factory()
            for lines in batches:
                if pos:
                    yield lines.map(lambda s: [f"{m}/{t}" for m, t in analyzer.pos(s)])
                else:
                    yield lines.map(lambda s: list(analyzer.morphs(s)))

        return df.withColumn(out, analyze(F.col(col)))

    _REGISTRY[name] = apply


register_expression("whitespace", tx.split_tokens)
register_expression("words", tx.split_punctuation)
register_expression("character", lambda c: F.filter(F.split(c, ""), lambda x: x != " "))
register_expression("jamo", lambda c: tx.split_tokens(to_jamo(c)))


def set_default(name: str) -> None:
    """Choose the tokenizer that unknown names fall back to."""
    global DEFAULT_TOKENIZER
    DEFAULT_TOKENIZER = name


def tokenize(
    df: DataFrame, name: str, pos: bool = False, col: str = "line", out: str = "tokens"
) -> DataFrame:
    """Strip, tokenize with the named tokenizer (unknown names use the default), split digits."""
    apply = _REGISTRY.get(name) or _REGISTRY[DEFAULT_TOKENIZER]
    stripped = df.withColumn(col, tx.strip_line(col))
    return apply(stripped, col, out, pos).withColumn(out, tx.split_digits(out))


def distinct_tokens(df: DataFrame, col: str = "tokens", out: str = "token") -> DataFrame:
    return unnest(df, [], col, out).distinct()


def _prefixes(tokens: DataFrame, shortest: int, longest: int) -> DataFrame:
    ends = F.sequence(F.lit(shortest), F.least(F.length("token"), F.lit(longest)))
    return (
        unnest(tokens.filter(F.length("token") >= shortest), ["token"], ends, "len")
        .withColumn("word", F.substring(F.col("token"), F.lit(1), F.col("len")))
    )


def merge_lexicon(base: DataFrame, user: DataFrame, key: str = "word") -> DataFrame:
    """The base lexicon with the user's words added; the user's entry wins."""
    return user.unionByName(base.join(user.select(key), key, "left_anti"))


def lexicon_tokenize(
    df: DataFrame,
    lexicon: DataFrame,
    col: str = "tokens",
    out: str = "tagged",
    line_keys: Sequence[str] = LINE_KEYS,
) -> DataFrame:
    """Dictionary tokens with tags, from white-space tokens.

    Our rule: the longest lexicon word that starts a token takes its lexicon tag; what is left is
    tagged by its own entry or ``UNK``; a token without any entry stays whole as ``UNK``. A lexicon
    within the broadcast limit is applied inside the task, else joined to each distinct token once.
    """
    lexicon, small = measured(lexicon.select("word", "tag"))
    longest = lexicon.agg(F.max(F.length("word"))).first()[0] or 1
    if small is not None:
        shared = df.sparkSession.sparkContext.broadcast(dict(zip(small.column(0).to_pylist(), small.column(1).to_pylist(), strict=True)))
        found = df.withColumn("_pieces", per_distinct(lambda token: lexicon_pieces(token, shared.value, longest), MORPHS)(F.col(col)))
    else:
        found = _lexicon_lookup(df, lexicon, longest, col, line_keys)
    unknown = lambda t: F.array(F.struct(t.alias("morph"), F.lit(UNKNOWN_TAG).alias("tag")))
    pieces = F.zip_with(col, "_pieces", lambda t, p: F.coalesce(p, unknown(t)))
    return found.withColumn(out, F.flatten(pieces)).drop("_pieces")


def lexicon_pieces(token: str, tags: Mapping[str, str | None], longest: int) -> list[dict] | None:
    """The longest word that starts the token and what is left, tagged; ``None`` without any entry."""
    n = next((n for n in range(min(len(token), longest), 0, -1) if token[:n] in tags), 0)
    if not n:
        return None
    head, rest = token[:n], token[n:]
    pieces = [{"morph": head, "tag": tags[head]}]
    return pieces + [{"morph": rest, "tag": UNKNOWN_TAG if tags.get(rest) is None else tags[rest]}] if rest else pieces


def _lexicon_lookup(df: DataFrame, lexicon: DataFrame, longest: int, col: str, line_keys: Sequence[str]) -> DataFrame:
    """``_pieces`` of every token by joins: the prefixes of each distinct token, then what is left of it."""
    hits = _prefixes(distinct_tokens(df, col), 1, longest).join(lexicon.select("word", "tag"), "word")
    best = hits.groupBy("token").agg(F.max_by(F.struct("len", "word", "tag"), "len").alias("head"))
    rest = best.withColumn("word", F.substr(F.col("token"), F.col("head.len") + 1))
    tagged = rest.join(
        lexicon.select("word", F.col("tag").alias("rest_tag")), "word", "left"
    ).select(
        "token",
        F.when(
            F.col("word") == "", F.array(F.struct(F.col("head.word").alias("morph"), F.col("head.tag").alias("tag")))
        ).otherwise(
            F.array(
                F.struct(F.col("head.word").alias("morph"), F.col("head.tag").alias("tag")),
                F.struct(
                    F.col("word").alias("morph"),
                    F.coalesce("rest_tag", F.lit(UNKNOWN_TAG)).alias("tag"),
                ),
            )
        ).alias("pieces"),
    )
    return lookup(df, col, tagged, "token", "pieces", "_pieces", line_keys)


def split_by_score(token: str, scores: dict, longest: int) -> list[str]:
    """The token, or its best-scored prefix of two characters or more and the rest."""
    if len(token) <= 2:
        return [token]
    found = [(scores[token[:n]], n) for n in range(2, min(len(token), longest) + 1) if token[:n] in scores]
    cut = max(found)[1] if found else len(token)
    return [token] if cut == len(token) else [token[:cut], token[cut:]]


def l_tokenize(
    df: DataFrame,
    scores: DataFrame,
    col: str = "line",
    out: str = "tokens",
    line_keys: Sequence[str] = LINE_KEYS,
) -> DataFrame:
    """Split each white-space token at the prefix with the highest score.

    ``scores`` holds (word, score) for words of any length. Tokens of up to two characters stay
    whole, an absent prefix scores 0, ties go to the longer left part. Scores within the broadcast
    limit are applied inside the task, else joined to each distinct token once.
    """
    lines = df.withColumn("_space", tx.split_tokens(col))
    scores, small = measured(scores.filter("score > 0").select("word", "score"))
    longest = scores.agg(F.max(F.length("word"))).first()[0] or 1
    if small is not None:
        known = dict(zip(small.column(0).to_pylist(), small.column(1).to_pylist()))
        shared = df.sparkSession.sparkContext.broadcast(known)
        cut_up = per_distinct(lambda token: split_by_score(token, shared.value, longest))
        return lines.withColumn(out, F.flatten(cut_up(F.col("_space")))).drop("_space")
    tokens = distinct_tokens(lines, "_space").filter(F.length("token") > 2)
    ranked = _prefixes(tokens, 2, longest).join(scores, "word")
    cuts = (
        ranked.groupBy("token")
        .agg(F.max(F.struct("score", "len"))["len"].alias("cut"))
        .filter(F.col("cut") < F.length("token"))
    )
    found = lookup(lines, "_space", cuts, "token", "cut", "_cut", line_keys)

    def parts(token: Column, cut: Column) -> Column:
        return F.when(cut.isNull(), F.array(token)).otherwise(
            F.array(F.substr(token, F.lit(1), cut), F.substr(token, cut + 1))
        )

    return found.withColumn(out, F.flatten(F.zip_with("_space", "_cut", parts))).drop("_space", "_cut")


def l_tokenize_lines(df: DataFrame, scores: DataFrame, col: str = "line", **options) -> DataFrame:
    """The whole tokenizing step: strip, normalize repeats (3), split by score."""
    clean = df.withColumn(col, normalize_repeats(tx.strip_line(col), 3))
    return l_tokenize(clean, scores, col, **options)


def encode_ids(
    df: DataFrame,
    vocab: DataFrame,
    col: str = "tokens",
    out: str = "ids",
    unknown: int = 0,
    line_keys: Sequence[str] = LINE_KEYS,
) -> DataFrame:
    """Tokens to vocabulary ids (``vocab``: token, id); ``unknown`` where absent."""
    found = lookup(df, col, vocab.select("token", F.col("id").cast("bigint").alias("id")), "token", "id", "_id", line_keys)
    filled = F.transform("_id", lambda i: F.coalesce(i, F.lit(unknown).cast("bigint")))
    return found.withColumn(out, filled).drop("_id")
