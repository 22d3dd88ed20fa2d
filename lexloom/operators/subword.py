"""Sub-word vocabularies in the format of greedy matching, and the matching.

It runs inside the task when the vocabulary fits the broadcast limit; a larger one is joined to the
substrings of the distinct words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import unnest
from ..session import measured
from .lookup import lookup, per_distinct
from .order import with_ordinal
from .pairmerge import META_PIECES, WORD_MARK
from .tokenizers import distinct_tokens

LINE_KEYS = ("doc_id", "line_no")

# The special tokens that open the vocabulary.
BERT_SPECIALS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")


def to_bert_vocab(pieces: DataFrame) -> DataFrame:
    """(id, token): the five specials, then the pieces in order, rewritten for greedy matching.

    A piece that starts a word loses every word mark; any other piece gets ``##`` in front. Meta
    pieces and the bare mark are left out, equal results are not merged.
    """
    spark = pieces.sparkSession
    head = spark.createDataFrame(list(enumerate(BERT_SPECIALS)), "id bigint, token string")
    kept = pieces.filter((F.col("piece") != "") & ~F.col("piece").isin(WORD_MARK, *META_PIECES))
    token = F.when(
        F.startswith("piece", F.lit(WORD_MARK)), F.replace("piece", F.lit(WORD_MARK), F.lit(""))
    ).otherwise(F.concat(F.lit("##"), F.col("piece")))
    body = with_ordinal(kept.select("id", token.alias("token")), ["id"], "_n")
    return head.unionByName(body.select((F.col("_n") + len(BERT_SPECIALS)).alias("id"), "token"))


# ---------------------------------------------------------------- greedy segmentation


def greedy_pieces(word: str, vocab: set, longest: int, max_chars: int | None = None) -> list[str]:
    """Longest vocabulary piece first, ``##`` on continuations; ``[UNK]`` when a part has none."""
    if max_chars is not None and len(word) > max_chars:
        return ["[UNK]"]
    pieces, at = [], 0
    while at < len(word):
        mark = "##" if at else ""
        ends = range(min(len(word), at + longest), at, -1)
        end = next((e for e in ends if mark + word[at:e] in vocab), None)
        if end is None:
            return ["[UNK]"]
        pieces.append(mark + word[at:end])
        at = end
    return pieces


def wordpiece_words(
    df: DataFrame,
    vocab: DataFrame,
    col: str = "words",
    out: str = "tokens",
    max_chars: int | None = None,
    line_keys: Sequence[str] = LINE_KEYS,
    nested: str | None = None,
) -> DataFrame:
    """Greedy pieces of the words in an array column; ``nested`` keeps them per word as well."""
    tokens, small = measured(vocab.select("token"))
    if small is None:
        table = _greedy_table(distinct_tokens(df, col, "word"), tokens, max_chars)
        found = lookup(df, col, table, "word", "pieces", "_pieces", line_keys)
    else:
        known = set(small.column(0).to_pylist())
        longest = max((len(t) for t in known), default=1)
        shared = df.sparkSession.sparkContext.broadcast(known)
        found = df.withColumn(
            "_pieces", per_distinct(lambda w: greedy_pieces(w, shared.value, longest, max_chars))(F.col(col))
        )
    made = found.withColumn(out, F.flatten("_pieces"))
    return made.withColumnRenamed("_pieces", nested) if nested else made.drop("_pieces")


def _greedy_table(words: DataFrame, tokens: DataFrame, max_chars: int | None) -> DataFrame:
    """(word, pieces) by joins: the longest piece at every start, then a walk over the starts."""
    longest = tokens.agg(F.max(F.length("token"))).first()[0] or 1
    short = words if max_chars is None else words.filter(F.length("word") <= max_chars)
    subs = _substrings(short, longest).withColumn(
        "token", F.when(F.col("start") == 1, F.col("sub")).otherwise(F.concat(F.lit("##"), F.col("sub")))
    )
    best = subs.join(tokens.distinct(), "token").groupBy("word", "start").agg(F.max("len").alias("len"))
    steps = best.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("start", "len"))).alias("steps"))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("pieces"))

    def walk(state: Column, step: Column) -> Column:
        mark = F.when(step["start"] == 1, "").otherwise("##")
        piece = F.concat(mark, F.substr(F.col("word"), step["start"], step["len"]))
        return F.when(
            step["start"] == state["at"],
            F.struct(
                (state["at"] + step["len"]).alias("at"), F.concat(state["pieces"], F.array(piece)).alias("pieces")
            ),
        ).otherwise(state)

    walked = steps.withColumn("w", F.aggregate("steps", start, walk))
    whole = F.when(F.col("w.at") == F.length("word") + 1, F.col("w.pieces"))
    unknown = F.array(F.lit("[UNK]"))
    return words.join(walked.select("word", whole.alias("pieces")), "word", "left").select(
        "word", F.coalesce("pieces", unknown).alias("pieces")
    )


def wordpiece(
    df: DataFrame,
    vocab: DataFrame,
    col: str = "line",
    out: str = "tokens",
    max_chars: int | None = None,
    line_keys: Sequence[str] = LINE_KEYS,
) -> DataFrame:
    """Clean a line, cut it into words and punctuation, then into vocabulary pieces (token)."""
    words = df.withColumn("_words", tx.split_punctuation(tx.strip_line(col)))
    return wordpiece_words(words, vocab, "_words", out, max_chars, line_keys).drop("_words")


def _substrings(words: DataFrame, longest: int) -> DataFrame:
    """(word, start, len, sub) of all substrings up to ``longest`` characters."""
    starts = unnest(words, ["*"], F.when(F.length("word") > 0, F.sequence(F.lit(1), F.length("word"))), "start")
    reach = F.least(F.lit(longest), F.length("word") - F.col("start") + 1)
    return unnest(starts, ["*"], F.sequence(F.lit(1), reach), "len").withColumn(
        "sub", F.substr(F.col("word"), F.col("start"), F.col("len"))
    )
