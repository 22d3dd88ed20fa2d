"""Encoding, decoding and token files against the tokenizers library."""

import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexloom.llm import bpe, tokenfile

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "aa", "b", "the", " ", "  ", "\n", "\t", " \n", "é", "漢", "1", "22", ".", "...", "'s", "<|endoftext|>", "\x1c",
          "\x85", "🙂", "ing", "tion", "-", "==", "​", "ſ", "x" * 40]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("make, kind", [(bpe.make_encoder, np.int32), (tokenfile.PieceEncoder, np.uint16)])
def test_encoders_equal_the_library(library, make, kind):
    encoder = make(open(PATH, encoding="utf-8").read())
    rnd = random.Random(1)
    texts = random_texts(6000, 2) + ["".join(rnd.choice("ab=-e.") for _ in range(rnd.randint(1, 70))) for _ in range(3000)]
    got = [np.frombuffer(x, kind).tolist() for i in range(0, len(texts), 500) for x in encoder.encode(texts[i : i + 500])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_round_trip(spark, odd_docs, library):
    rows = bpe.decode_ids(bpe.encode_texts(odd_docs, PATH), PATH).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")
    both = bpe.encode_texts(odd_docs, PATH, decoded="decoded").collect()
    assert sorted(map(str, both)) == sorted(map(str, rows))


def test_decoding_ids_that_are_no_text(spark, library):
    lists = [[220, 10263], [], None, [50256, 1]]
    docs = spark.createDataFrame([(x,) for x in lists], "ids array<int>")
    got = [r.decoded for r in bpe.decode_ids(docs, PATH).collect()]
    assert got == [None if x is None else library.decode(x, skip_special_tokens=False) for x in lists]


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n in (1, 63, 512, 5000):
        for width, high in ((16, 300), (32, 1 << 20)):
            tokens = rng.integers(0, high, n).astype(np.uint16 if width == 16 else np.uint32)
            matrix = tokenfile.WaveletMatrix.build(tokens, width)
            assert (matrix.tokens() == tokens).all()
            at = rng.integers(0, n, 50)
            assert (matrix.access(at) == tokens[at]).all()
            for token in (int(tokens[0]), int(tokens[-1]), high):
                assert (matrix.locate(token) == np.flatnonzero(tokens == token)).all()
                assert matrix.count(token, n // 3, n) == (tokens[n // 3 :] == token).sum()


def write(spark, docs, tmp_path, **more):
    folder = str(tmp_path / uuid.uuid4().hex)
    tokenfile.write_tokens(docs, folder, PATH, 2, **more)
    return tokenfile.open_shards(spark, folder)


def test_token_files(spark, odd_docs, library, tmp_path):
    texts = dict(enumerate(random_texts(300, 5)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    shards = write(spark, docs, tmp_path, shard_tokens=500)
    assert shards.count() > 8
    rows = sorted(tokenfile.read_documents(shards).collect(), key=lambda r: r.start)
    at, every = 0, []
    for r, (doc, text) in zip(rows, sorted(texts.items()), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        assert tuple(r) == (doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
        every += ids
    for token in (2, 64, 50000):
        places = [i for i, x in enumerate(every) if x == token]
        assert sorted(r.place for r in tokenfile.locate_token(shards, token).collect()) == places
        assert (tokenfile.count_token(shards, token).agg(F.sum("n")).first()[0] or 0) == len(places)


def test_token_files_of_odd_rows(spark, odd_docs, no_docs, library, tmp_path):
    rows = tokenfile.read_documents(write(spark, odd_docs, tmp_path)).collect()
    want = sorted(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
    assert sorted(r.n_tokens for r in rows) == want
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)][:2] == [None, None]
    assert tokenfile.read_documents(write(spark, no_docs, tmp_path)).count() == 0
    assert bpe.encode_texts(no_docs, PATH).count() == 0
