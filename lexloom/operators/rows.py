"""Line frames: documents to lines, label handling, blank lines, tagged tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import unnest


def explode_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line of every document, keyed by (document, line number)."""
    return unnest(docs, [key], F.split(F.col(text), "\n"), "line", "line_no")


def parse_labelled(lines: DataFrame, col: str = "line") -> tuple[DataFrame, DataFrame]:
    """Split ``text␞label`` lines into (sound rows with ``label``, corrupt rows as they came)."""
    fields = tx.labelled_fields(col)
    sound = F.size(fields) == 2
    good = lines.filter(sound).withColumns({col: fields[0], "label": fields[1]})
    return good, lines.filter(~F.coalesce(sound, F.lit(False)))


def format_labelled(df: DataFrame, col: str = "line", label: str = "label") -> DataFrame:
    """Join text and label back into one ``text␞label`` line."""
    return df.withColumn(col, F.concat_ws(tx.LABEL_MARK, F.col(col), F.col(label)))


def drop_blank(df: DataFrame, col: str = "line") -> DataFrame:
    return df.filter(F.col(col) != "")


def with_label(df: DataFrame, fn: Callable[[Column], Column], col: str = "line") -> DataFrame:
    """Apply a text expression to the line; every other column, the label too, stays."""
    return df.withColumn(col, fn(F.col(col)))


def label_flag(value: str) -> bool:
    """The command line's label switch: on only for "true" in any case."""
    return value.lower() == "true"


def to_sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per sentence, the document and the order kept."""
    return unnest(docs, [key], tx.sentences_of(text), "sentence", "sent_no")


def format_pos(tagged, pos: bool = False) -> Column:
    """Tagged tokens as ``morph/TAG`` strings, or as the part before the first slash."""
    tokens = F.col(tagged) if isinstance(tagged, str) else tagged
    rendered = F.transform(tokens, lambda t: F.concat_ws("/", t["morph"], t["tag"]))
    return rendered if pos else F.transform(rendered, lambda t: F.substring_index(t, "/", 1))


def with_split(df: DataFrame, key: str = "doc_id", test_share: float = 0.2, seed: int = 7) -> DataFrame:
    """Train / test membership as a column, decided by the hashed key."""
    from ..functions.hashing import hash32

    bucket = F.pmod(hash32(seed, F.col(key)), F.lit(1000))
    return df.withColumn("split", F.when(bucket < int(test_share * 1000), "test").otherwise("train"))
