"""Byte-level BPE encoding over a trie of distinct words, and decoding.

The encoding of a text's prefix ends in one token, its *last token*; taking that token away leaves
the encoding of a shorter prefix. So a node of a trie of words needs to keep only its last token and
the node where that token begins, and every prefix that words share is worked out once. For a new
node the vocabulary's tokens that end there compete; the one that stays whole beside the last token
before it is the answer (two tokens stay whole if no merge across their border comes before the
merges that built them).

The vocabulary is a file of the ``tokenizers`` library. It is read on the driver and broadcast; its
size is that of the file. Splitting into words is left to the library's own splitter.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PIECES = 120_000  # of a task's tables of words and of pieces between spaces
RENEW = 40  # times as many pieces missed, before they start anew
MAX_PAIRS = 1_000_000  # of the remembered pairs of tokens, which then start anew
MAX_WORDS = 20_000  # encoded at once
GROUP_BYTES = 2 << 20  # of texts, or elements of id arrays, at once
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
# Splitting rule of the file format (a fixed value), with its letter and digit classes written out for
# the characters of _SIMPLE, whose classes no Unicode version changes; other texts go to the library.
_SIMPLE = re.compile("[\\n\\x20-\\x7eÀ-ÖØ-öø-ſ]*")
_WORDS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ſ]+| ?[0-9]+| ?[^\\sA-Za-zÀ-ÖØ-öø-ſ0-9]+|\\s+(?!\\S)|\\s+"
)
# Where white space touches a space from both sides, cutting there could change the words.
_UNSAFE = re.compile(r"\s \s|\s \Z")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and splitter of a byte-level BPE file."""

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use every core
        from tokenizers.pre_tokenizers import ByteLevel

        spec = json.loads(source)
        model, splitter = spec["model"], spec["pre_tokenizer"] or {}
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if model["type"] != "BPE" or splitter.get("type") != "ByteLevel" or not splitter["use_regex"] or splitter["add_prefix_space"]:
            raise ValueError("a byte-level BPE file is needed")
        if spec["normalizer"] or model.get("byte_fallback"):
            raise ValueError("normalizers and byte fallback are not supported")
        if any(a[flag] for a in spec["added_tokens"] for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that look at their surroundings are not supported")
        self.added = added
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        vocab: dict[str, int] = model["vocab"]
        self.words = ByteLevel(add_prefix_space=False).pre_tokenize_str  # the library's splitter alone
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.rank[a << 32 | b] = rank
            self.parts[whole] = (a, b, rank)
        to_byte = {c: b for b, c in enumerate(byte_characters())}
        self.to_byte = to_byte
        ids = {**vocab, **added}
        self.bytes_of = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            known = all(c in to_byte for c in token)
            self.bytes_of[i] = bytes(map(to_byte.__getitem__, token)) if known else token.encode()
        self._edges: tuple[dict, dict] = ({}, {})
        # Tokens that merging builds from their own bytes; a vocabulary may hold others, which never appear.
        single = {i for i in vocab.values() if i not in self.parts}
        self.tokens = {self.bytes_of[i]: i for i in single if len(self.bytes_of[i]) == 1}
        made = set(self.tokens.values())
        for whole, (a, b, _) in self.parts.items():  # in the order of the merges
            if a in made and b in made and self.stay_whole(a, b, whole):
                made.add(whole)
                self.tokens[self.bytes_of[whole]] = whole
        self.longest = [1] * 256  # of the tokens that end in a byte
        for token in self.tokens:
            self.longest[token[-1]] = max(self.longest[token[-1]], len(token))

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stood at one side (0 left, 1 right) of ``token`` while it was built, each
        with the rank of the merge that took it in."""
        known = self._edges[side].get(token)
        if known is None:
            known, at, until = [], token, float("inf")
            while True:
                known.append((at, until))
                if at not in self.parts:
                    break
                *ends, until = self.parts[at]
                at = ends[side]
            self._edges[side][token] = known
        return known

    def stay_whole(self, a: int, b: int, whole: int = -1) -> bool:
        """Whether the text of ``a`` and ``b`` is encoded as these two tokens, or as ``whole``, their merge.

        A merge across the border wins if it comes before both its parts are taken in; among equal
        merges the left one comes first.
        """
        rank, own = self.rank, self.parts[whole][2] if whole >= 0 else -1
        for x, until_x in self.edge(a, 1):
            for y, until_y in self.edge(b, 0):
                r = rank.get(x << 32 | y)
                if r is not None and r < until_x and r <= until_y and (own < 0 or r < own):
                    return False
        return True


class WordTrie:
    """Encodes sets of distinct words, every prefix they share once.

    Sorted words are the leaves of their trie in depth-first order. A node is the first word that
    has its prefix, with the prefix's length; a word that shares fewer bytes with the one before it
    begins new nodes. States of all nodes of a depth are worked out together, from the longest
    token that may end there to the shortest. Whether two tokens stay whole is remembered.
    """

    LONG = 32  # bytes; longer words are encoded one by one

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_size: dict[int, list] = {}
        for token, i in vocabulary.tokens.items():
            if len(token) <= self.LONG:
                by_size.setdefault(len(token), []).append((token, i))
        for size, entries in by_size.items():
            hashes = self._prefix_hashes(np.array([list(t) for t, _ in entries], np.uint8))[-1]
            order = np.argsort(hashes)
            seen = np.zeros(1 << 18, bool)
            seen[hashes >> np.uint64(46)] = True
            self.tables[size] = (seen, hashes[order], np.array([i for _, i in entries], np.int32)[order])
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.LONG, _BASE)]), dtype=np.uint64)
        self.recent: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.pairs, self.whole = np.zeros(0, np.int64), np.zeros(0, bool)

    @staticmethod
    def _prefix_hashes(letters: np.ndarray) -> np.ndarray:
        """Row d: the hashes of the first d bytes of every word."""
        out = np.zeros((letters.shape[1] + 1, letters.shape[0]), np.uint64)
        for d in range(letters.shape[1]):
            out[d + 1] = out[d] * _BASE + _BYTES[letters[:, d]]
        return out

    def _stay_whole(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        keys = before.astype(np.int64) << 32 | token
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            known, out = self.pairs[at] == keys, self.whole[at]
        else:
            known, out = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        if not known.all():
            new, inverse = np.unique(keys[~known], return_inverse=True)
            recent, answers = self.recent, []
            for key in new.tolist():
                answer = recent.get(key)
                if answer is None:
                    answer = recent[key] = self.vocabulary.stay_whole(key >> 32, key & 0xFFFFFFFF)
                answers.append(answer)
            out[~known] = np.array(answers)[inverse]
        return out

    def _remember(self) -> None:
        if len(self.pairs) + len(self.recent) > MAX_PAIRS:
            self._forget()
        pairs = np.concatenate([self.pairs, np.fromiter(self.recent, np.int64, len(self.recent))])
        whole = np.concatenate([self.whole, np.fromiter(self.recent.values(), bool, len(self.recent))])
        order = np.argsort(pairs)
        self.pairs, self.whole, self.recent = pairs[order], whole[order], {}

    def encode(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """The ids of every word, as 32-bit integers."""
        made, short = {}, []
        for word in words:
            if len(word) > self.LONG:
                made[word] = self._encode_long(word)
            elif word:
                short.append(word)
        short.sort()
        for low in range(0, len(short), MAX_WORDS):
            made.update(self._encode_short(short[low : low + MAX_WORDS]))
        return made

    def _encode_short(self, words: list[bytes]) -> dict[bytes, bytes]:
        n, sizes = len(words), np.fromiter(map(len, words), np.int64, len(words))
        longest = int(sizes.max())
        letters = np.array(words, f"S{longest}").view(np.uint8).reshape(n, longest)
        hashes = self._prefix_hashes(letters)
        same = letters[1:] == letters[:-1]
        same &= np.arange(longest) < np.minimum(sizes[1:], sizes[:-1])[:, None]
        shared = np.concatenate([[-1], np.cumprod(same, axis=1, dtype=np.int8).sum(axis=1)])
        rows = np.arange(n)
        # node[d, i]: the first word with the first d bytes of word i
        node = np.maximum.accumulate(np.where(shared < np.arange(longest + 1)[:, None], rows, 0).astype(np.int32), axis=1)
        last = np.full((longest + 1, n), -1, np.int32)  # the last token of a node's prefix
        length = np.zeros((longest + 1, n), np.int8)  # and its bytes
        for d in range(1, longest + 1):
            waiting = np.flatnonzero((shared < d) & (sizes >= d))
            for size in range(d, 0, -1):
                if size not in self.tables or not len(waiting):
                    continue
                seen, known, ids = self.tables[size]
                here = hashes[d, waiting] - hashes[d - size, waiting] * self.powers[size]
                may = seen[here >> np.uint64(46)]
                found, here = waiting[may], here[may]
                at = np.minimum(np.searchsorted(known, here), len(known) - 1)
                right = known[at] == here
                found, token = found[right], ids[at[right]]
                if size < d:
                    whole = self._stay_whole(last[d - size, node[d - size, found]], token)
                    found, token = found[whole], token[whole]
                last[d, found] = token
                length[d, found] = size
                waiting = waiting[last[d, waiting] < 0]
            if len(waiting):
                raise ValueError("the vocabulary lacks a byte")
        self._remember()
        # Back from the ends of the words, token by token.
        out = np.zeros((n, longest), np.int32)
        left, column, active = sizes.copy(), longest, rows
        counts = np.zeros(n, np.int64)
        while len(active):
            column -= 1
            counts[active] += 1
            at = node[left[active], active]
            out[active, column] = last[left[active], at]
            left[active] -= length[left[active], at]
            active = active[left[active] > 0]
        data = out.tobytes()
        row = 4 * longest
        return {
            word: data[row * (i + 1) - 4 * c : row * (i + 1)] for i, (word, c) in enumerate(zip(words, counts.tolist(), strict=True))
        }

    def _encode_long(self, word: bytes) -> bytes:
        tokens, longest, whole = self.vocabulary.tokens, self.vocabulary.longest, self.vocabulary.stay_whole
        last, begin = array("i", [-1]), array("q", [0])
        for depth, byte in enumerate(word, 1):
            for start in range(max(0, depth - longest[byte]), depth):
                token = tokens.get(word[start:depth])
                if token is not None and (start == 0 or whole(last[start], token)):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            last.append(token)
            begin.append(start)
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at = begin[at]
        return np.array(ids[::-1], np.int32).tobytes()


class Encoder:
    """Texts to token ids. Pieces between spaces and words are kept; new words go through the trie."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.trie = WordTrie(vocabulary)
        self.pieces: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.missed = 0

    def _split(self, text: str) -> list[str]:
        """Pieces of a text without added tokens, whose encodings follow one another."""
        if _UNSAFE.search(text):
            return [text]
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + r for r in rest]

    def _words(self, piece: str) -> list[bytes]:
        if _SIMPLE.fullmatch(piece):
            return [w.encode() for w in _WORDS.findall(piece)]
        byte = self.vocabulary.to_byte.__getitem__
        return [bytes(map(byte, word)) for word, _ in self.vocabulary.words(piece)]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that are not kept. Full tables stay as they are until the texts have changed
        so far that they rarely help."""
        split = {p: self._words(p) for p in pieces}
        words = self.words
        new = self.trie.encode({w for ws in split.values() for w in ws if w not in words})
        made = {p: b"".join([words.get(w) or new[w] for w in ws]) for p, ws in split.items()}
        for table, fresh in ((self.pieces, made), (words, new)):
            if len(table) < MAX_PIECES:
                table.update(fresh)
        self.missed += len(made)
        if self.missed > RENEW * MAX_PIECES:
            self.pieces, self.words, self.missed = {}, {}, 0
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, as 32-bit integers."""
        added, get = self.vocabulary.added, self.pieces.get
        cut: list[list] = []
        new: set[str] = set()
        for text in texts:
            parts = self.vocabulary.split_added.split(text) if any(a in text for a in added) else [text]
            rows: list = []
            for number, part in enumerate(parts):
                if number % 2:
                    rows.append(np.int32(added[part]).tobytes())
                elif part:
                    pieces = self._split(part)
                    found = list(map(get, pieces))
                    if None in found:
                        new.update([p for p, x in zip(pieces, found, strict=True) if x is None])
                    rows.append((pieces, found))
            cut.append(rows)
        made = self._learn(new)

        def joined(row) -> bytes:
            if type(row) is bytes:
                return row
            pieces, found = row
            return b"".join([made[p] if x is None else x for p, x in zip(pieces, found, strict=True)] if None in found else found)

        return [b"".join(map(joined, rows)) for rows in cut]


class Shared(NamedTuple):
    """A file's text, broadcast, under a name that tells its content."""

    name: str
    content: object


_built: dict[tuple, object] = {}


def per_worker(shared: Shared, make: Callable):
    """What ``make`` builds from the shared text, once in each Python worker."""
    key = (shared.name, make.__name__)
    if key not in _built:
        _built.clear()
        _built[key] = make(shared.content.value)
    return _built[key]


def load_vocabulary(spark: SparkSession, path: str) -> Shared:
    """The vocabulary file, read on the driver and broadcast: its size is fixed by the file."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return Shared(hashlib.sha256(text.encode()).hexdigest(), spark.sparkContext.broadcast(text))


def make_encoder(source: str) -> Encoder:
    return Encoder(Vocabulary(source))


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of about ``GROUP_BYTES``."""
    low, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        held += size
        if held >= GROUP_BYTES:
            yield low, row + 1
            low, held = row + 1, 0
    if low < len(sizes):
        yield low, len(sizes)


def _map_rows(docs: DataFrame, column: str, added: list[tuple[str, T.DataType]], work: Callable) -> DataFrame:
    """``docs`` with columns that ``work`` makes from one column, a few rows at a time, so that a task
    never holds the results of a whole batch."""
    names = {name.lower() for name, _ in added}
    rest = [c for c in docs.columns if c.lower() not in names]
    kept = [f for f in docs.schema.fields if f.name in rest]
    made = T.StructType(kept + [T.StructField(n, t) for n, t in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(batch.num_columns - 1)
            sizes = pc.fill_null(pc.binary_length(values) if pa.types.is_string(values.type) else pc.list_value_length(values), 0)
            for low, high in _groups(sizes.to_numpy(zero_copy_only=False)):
                part = batch.slice(low, high - low)
                columns = [part.column(i) for i in range(len(rest))]
                yield pa.RecordBatch.from_arrays(columns + work(part.column(len(rest))), names=made.names)
            pa.default_memory_pool().release_unused()  # what a batch took, before the next one

    given = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{column}`").alias("_given"))
    return given.mapInArrow(run, made)


def _id_lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *[len(p) // 4 for p in parts]], dtype=np.int64).astype(np.int32)
    ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(ends), ids)


def _decode(token: Callable[[int], bytes], ids: Iterable[int]) -> str:
    return b"".join(map(token, ids)).decode("utf-8", "replace")


def encode_texts(docs: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the token ids of every whole text in ``out``, and on request their text in ``decoded``.

    The ids are those of the library for the same file with ``add_special_tokens=False``. NULL and
    empty texts get an empty array. Columns already called so are replaced; rows are kept as they
    are, repeated ones too, and an empty table stays empty.
    """
    shared = load_vocabulary(docs.sparkSession, path)

    def encode(texts: pa.Array) -> list[pa.Array]:
        encoder = per_worker(shared, make_encoder)
        parts = encoder.encode([t or "" for t in texts.to_pylist()])
        made = [_id_lists(parts)]
        if decoded:
            token = encoder.vocabulary.bytes_of.__getitem__
            made.append(pa.array([_decode(token, np.frombuffer(p, np.int32).tolist()) for p in parts], pa.string()))
        return made

    added = [(out, T.ArrayType(T.IntegerType()))] + ([(decoded, T.StringType())] if decoded else [])
    return _map_rows(docs, text, added, encode)


def decode_ids(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids`` in ``out``, special tokens included; NULL ids give NULL.

    Bytes that are no UTF-8 become U+FFFD.
    """
    shared = load_vocabulary(docs.sparkSession, path)

    def decode(lists: pa.Array) -> list[pa.Array]:
        token = per_worker(shared, make_encoder).vocabulary.bytes_of.__getitem__
        return [pa.array([None if x is None else _decode(token, x) for x in lists.to_pylist()], pa.string())]

    return _map_rows(docs, ids, [(out, T.StringType())], decode)
