"""One reproducible hash for every job that looks random: md5 of the seed and the row's keys."""

from __future__ import annotations

import math
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(*parts) -> Column:
    """The parts, without NULLs, joined by ``|``: what a hash is taken of."""
    return F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def continued(start: Column, last: Column) -> Column:
    """``joined`` with one more part that is not NULL, for elements of an array whose row has one ``start``."""
    return F.concat(start, F.lit("|"), last.cast("string"))


def rank_text(text: Column) -> Column:
    """The hash of a joined text as eight hexadecimal digits, which sort like the number."""
    return F.substring(F.md5(text), 1, 8)


def number(text: Column) -> Column:
    """The hash of a joined text as a BIGINT in [0, 2^32)."""
    return F.conv(rank_text(text), 16, 10).cast("bigint")


def hash32(*parts) -> Column:
    """First 32 bits of md5 over the parts joined by ``|``, as a BIGINT in [0, 2^32)."""
    return number(joined(*parts))


def unit_hash(*parts) -> Column:
    """``hash32`` scaled to [0, 1)."""
    return hash32(*parts) / F.lit(4294967296.0)


# ---------------------------------------------------------------- many hashes of one row

_ADDED = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_TURNED = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_READ = [(1, 0), (5, 1), (3, 5), (7, 0)]  # of step i the word (a i + b) mod 16
_STATE = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_CHUNK = 1 << 13  # hashes worked on at the same time, so that they stay in the processor's cache


def _first_words(blocks: np.ndarray) -> np.ndarray:
    """The first 32 bits of md5, as numbers, of messages of one padded block (n x 64 bytes) each."""
    words = np.ascontiguousarray(blocks.view("<u4").T)
    a, b, c, d = (np.full(words.shape[1], x, np.uint32) for x in _STATE)
    f, t = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        kind = i >> 4
        if kind < 2:  # one of two by the bits of the third
            one, two, by = (c, d, b) if kind == 0 else (b, c, d)
            np.bitwise_xor(one, two, out=f)
            f &= by
            f ^= two
        elif kind == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.bitwise_not(d, out=f)
            f |= b
            f ^= c
        f += a
        f += words[(_READ[kind][0] * i + _READ[kind][1]) & 15]
        f += _ADDED[i]
        by_bits = _TURNED[kind][i & 3]
        np.left_shift(f, np.uint32(by_bits), out=t)
        f >>= np.uint32(32 - by_bits)
        f |= t
        f += b
        a, b, c, d, f = d, f, b, c, a
    return (a + np.uint32(_STATE[0])).byteswap()


def numbers_at(starts: pa.Array, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``number`` of ``continued(starts[owner], at)``, one for each place ``at``, which is not negative."""
    out = np.zeros(len(at), np.int64)
    if not len(at):
        return out
    texts = [t.encode() for t in starts.to_pylist()]
    tails = [f"|{i}".encode() for i in range(int(at.max()) + 1)] if at.max() < 1 << 16 else None
    if tails is None or max(map(len, texts)) + len(tails[-1]) > 55:  # more than one block
        for k, (o, i) in enumerate(zip(owner.tolist(), at.tolist())):
            out[k] = int.from_bytes(md5(texts[o] + b"|%d" % i).digest()[:4], "big")
        return out
    starts_of = np.frombuffer(b"".join(t.ljust(64, b"\0") for t in texts), np.uint8).reshape(-1, 64)
    size, width = np.array(list(map(len, texts))), len(tails[-1]) + 1
    ends = np.frombuffer(b"".join((t + b"\x80").ljust(width, b"\0") for t in tails), np.uint8).reshape(-1, width)
    more = np.array(list(map(len, tails)))
    for low in range(0, len(at), _CHUNK):
        o, i = owner[low : low + _CHUNK], at[low : low + _CHUNK]
        blocks, rows, begin = starts_of[o], np.arange(len(o)), size[o]
        for k in range(width):
            blocks[rows, begin + k] = ends[i, k]
        blocks.view("<u4")[:, 14] = (begin + more[i]) * 8
        out[low : low + _CHUNK] = _first_words(blocks)
    return out


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def hashes_at(start: Column, at: Column) -> Column:
    """``number(continued(start, i))`` for every i of an array of places; worked out side by side for a batch."""

    def find(starts: pa.Array, places: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(places).to_numpy(zero_copy_only=False).astype(np.int64)
        return _lists(sizes, pa.array(numbers_at(starts, np.repeat(np.arange(len(sizes)), sizes), flat)))

    return F.arrow_udf(find, returnType="array<bigint>")(start, at)


def unit_hashes(start: Column, n: int) -> Column:
    """``n`` numbers in [0, 1): ``unit_hash`` of the joined ``start`` and 0, 1, ..."""

    def find(starts: pa.Array) -> pa.Array:
        rows = len(starts)
        found = numbers_at(starts, np.repeat(np.arange(rows), n), np.tile(np.arange(n), rows))
        return _lists(np.full(rows, n), pa.array(found / 4294967296.0))

    return F.arrow_udf(find, returnType="array<double>")(start)
