"""Sentence boundaries with abbreviations learned from the corpus itself (Kiss and Strunk 2006).

A word that nearly always has a period behind it, short and often with periods inside, is an
abbreviation. The period behind it, or behind an initial, does not end a sentence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import unnest
from ..session import cut_lineage
from .lookup import lookup

LEAST_SCORE = 0.3
WITH_PERIOD = 0.99  # how often an abbreviation has its period


def _word(token: Column) -> Column:
    """Lower-case, without what surrounds a word."""
    return F.lower(F.regexp_replace(token, r"^[(\"']+|[)\"',;:!?]+$", ""))


def period_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n_period, n_plain): how often each word without digits stands with and without a period."""
    tokens = unnest(docs, [], tx.split_tokens(text), "token").select(_word(F.col("token")).alias("token"))
    ends = F.endswith("token", F.lit("."))
    word = F.when(ends, F.substr("token", F.lit(1), F.length("token") - 1)).otherwise(F.col("token"))
    words = tokens.select(word.alias("word"), ends.alias("period"))
    words = words.filter(F.rlike("word", F.lit(r"\p{L}")) & ~F.rlike("word", F.lit(r"[\p{Nd}]|\.$")))
    return words.groupBy("word").agg(F.count_if("period").alias("n_period"), F.count_if(~F.col("period")).alias("n_plain"))


def _log_likelihood(k: Column, n: Column, p: Column) -> Column:
    return k * F.ln(p) + (n - k) * F.ln(1 - p)


def abbreviations(counts: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """(word, n_period, n_plain, score) of the words that count as abbreviations.

    The score is the log-likelihood ratio of ``WITH_PERIOD`` against the share of periods among all
    words, times exp(-letters), times one more than the inner periods, and divided by the letters to
    the power of the occurrences without a period.
    """
    total = counts.agg(F.sum("n_period"), F.sum(F.col("n_period") + F.col("n_plain"))).first()
    share = F.lit((total[0] or 0) / (total[1] or 1))
    k, n = F.col("n_period").cast("double"), (F.col("n_period") + F.col("n_plain")).cast("double")
    ratio = -2 * (_log_likelihood(k, n, share) - _log_likelihood(k, n, F.lit(WITH_PERIOD)))
    inner = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit("")))
    letters = (F.length("word") - inner).cast("double")
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -F.col("n_plain").cast("double"))
    scored = counts.filter("n_period > 0").withColumn("score", score)
    return scored.filter(F.col("score") >= least)


def to_sentences(docs: DataFrame, known: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sent_no, sentence): one row a sentence, in order.

    Candidates end at newlines and after ``.``, ``!`` or ``?`` plus space. A period that follows an
    abbreviation (``known``: word; learned from these documents if it is not given) or an initial
    ends no sentence within its line.
    """
    known = abbreviations(cut_lineage(period_counts(docs, text))) if known is None else known
    given = docs.select(key, tx.sentence_candidates(text).alias("_parts"))
    words = F.transform("_parts", lambda c: _word(F.coalesce(tx.last_word(c), F.lit(""))))
    initials = F.transform("_parts", lambda c: F.rlike(F.coalesce(tx.last_word(c), F.lit("")), F.lit(r"^\p{Lu}$")))
    given = given.withColumns({"_last": words, "_initial": initials})
    marked = lookup(given, "_last", known.select("word", F.lit(True).alias("is")), "word", "is", "_is", [key])
    goes_on = F.zip_with("_initial", "_is", lambda i, a: i | F.coalesce(a, F.lit(False)))
    return unnest(marked, [key], tx.joined_sentences(F.col("_parts"), goes_on), "sentence", "sent_no")
