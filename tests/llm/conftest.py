import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def odd_docs(spark):
    """Rows with NULLs, empty and long texts, ties and repeats, and columns named like outputs."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    line = "the same ten words of text on one line again and again"
    rows = [
        (1, f"{line}\nan own line of words one", "a"),
        (2, f"{line}\nan own line of words two", "a"),
        (3, None, None),
        (None, f"token = 'abcdefgh1' {line}", None),
        (None, f"token = 'abcdefgh1' {line}", None),
        (4, "", "b"),
        (5, " \n\t ", "b"),
        (6, long, "a"),
        (7, long, "c"),
        (8, "mail a.b@c.example.org or +1 (555) 010-9999, card 4111 1111 1111 1111, ip 10.0.0.255 é🙂", "c"),
        (8, "mail a.b@c.example.org or +1 (555) 010-9999, card 4111 1111 1111 1111, ip 10.0.0.255 é🙂", "c"),
        (8, "AKIAABCDEFGHIJKL and 0123456789abcdef0123456789abcdef <|endoftext|> end", "c"),
        (9, "x", ""),
    ]
    rows = [(*r, "s", 7, True, "t", 1.5) for r in rows]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, source string, spans string, size int, kept boolean, shard string, `_row` double"
    )


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.filter("1 = 0")
