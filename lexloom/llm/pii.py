"""Personal data by weak supervision.

Strict patterns find the certain spans. Looser patterns find candidates, and labelers vote on every
span (for, against, abstain): its form, a gazetteer, the words around it, and its edges. From the
counts of vote patterns, expectation-maximisation estimates how far each labeler can be trusted for
each kind, without any labelled text; the posteriors then train a logistic classifier on votes and
shape, which decides on the candidates. Certain spans always stay.

A text is read once. What reaches the driver is the count of each pattern of votes and shape, at most
``len(KINDS) * PATTERNS`` rows however many spans there are; counts cover all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
BASE_KINDS = 4
LABELERS = ("form", "gazetteer", "context", "edges")
VOTES = 3 ** len(LABELERS)
DIGIT_BUCKETS, SEPARATORS = 6, 2
PATTERNS = VOTES * DIGIT_BUCKETS * SEPARATORS
THRESHOLD = 0.9
ROUNDS = 50
NEAR = 48  # characters before a span in which its context is read, half as many after it

# The contract's patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts where no digit precedes: from inside a run of digits the same would follow.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser forms, by kind.
_LOOSE = {
    0: re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[](?:at|AT)[)\]] ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[](?:dot|DOT)[)\]]) ?[A-Za-z0-9-]+)+"),
    1: re.compile(r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"),
    2: re.compile(r"(?<![0-9A-Za-z])[0-9](?:[\x20-]?[0-9])+(?![0-9A-Za-z])"),  # numbers of a card's length whose check sum fails
    3: re.compile(r"\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4})?"),
    4: re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    5: re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"),
}
# Gazetteers and cue words: our own short lists.
_TOP_DOMAINS = frozenset("com org net edu gov io info biz de fr es uk us ca au jp cn ru it nl eu ch example".split())
_IBAN_COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
_CUES = {
    0: frozenset("mail email contact write address reach".split()),
    1: frozenset("ip host server client address login network".split()),
    2: frozenset("card visa credit debit mastercard payment pay".split()),
    3: frozenset("phone call tel telephone mobile fax cell contact dial".split()),
    4: frozenset("ssn social security".split()),
    5: frozenset("iban bank account transfer".split()),
}
_AGAINST = frozenset("version release isbn license section chapter page figure equation order invoice serial".split())
_LETTERS = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    """Whether the digits' check sum holds."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From one @ to the next, so that a long run of letters is read once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Certain spans (kind, start, end), by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not re.search("[0-9]", text):
        return found
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m[0])) <= 15:
            found.append((3, *m.span()))
    return found


def candidate_spans(text: str, base: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the looser forms that touch no certain span and no earlier candidate, by kind, then start."""
    found: list[tuple[int, int, int]] = []
    if not re.search(r"[0-9]|[(\[](?:at|AT)[)\]]", text):
        return found
    taken = bytearray(len(text))  # characters of a span: one look at each, however many spans there are
    for _, a, b in base:
        taken[a:b] = b"\1" * (b - a)
    for kind in (5, 4, 1, 0, 2, 3):
        for m in _LOOSE[kind].finditer(text):
            a, b = m.span()
            if taken.find(1, a, b) < 0 and (kind != 2 or 13 <= len(_digits(m[0])) <= 19):
                found.append((kind, a, b))
                taken[a:b] = b"\1" * (b - a)
    return sorted(found)


def _form(kind: int, span: str) -> int:
    digits = _digits(span)
    if kind == 2:
        return 1 if luhn(digits) else -1
    if kind == 3:
        return 1 if 9 <= len(digits) <= 15 else -1
    if kind == 4:
        return -1 if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" or span[7:] == "0000" else 1
    if kind == 5:
        code = span.replace(" ", "")
        number = "".join(str(int(c, 36)) for c in code[4:] + code[:4])
        return 1 if 15 <= len(code) <= 34 and int(number) % 97 == 1 else -1
    return 1 if kind == 0 or span.count(".") == 3 or span.count(":") == 7 else 0


def _gazetteer(kind: int, span: str) -> int:
    if kind == 0:
        return 1 if re.split(r"[^A-Za-z]+", span)[-1].lower() in _TOP_DOMAINS else 0
    if kind == 1:
        return -1 if span.startswith("0.") else 1 if span.startswith(("10.", "127.", "172.", "192.168.")) else 0
    if kind == 2:
        return 1 if span[0] in "3456" else -1
    if kind == 3:
        return 1 if span.startswith("+") else 0
    return (1 if span[:2] in _IBAN_COUNTRIES else -1) if kind == 5 else 0


def _edges(text: str, a: int, b: int) -> int:
    """Against a span inside a longer word or number, for one between spaces or brackets."""
    before, after = text[a - 1 : a], text[b : b + 1]
    if before.isalnum() or after.isalnum():
        return -1
    return 1 if (not before or before in " \n\t(<[\"':;,") and (not after or after in " \n\t)>]\"':;,.!?") else 0


def votes(text: str, kind: int, a: int, b: int) -> tuple[int, ...]:
    """One vote per labeler: 1 for, -1 against, 0 abstains."""
    span = text[a:b]
    around = set(_LETTERS.findall((text[max(0, a - NEAR) : a] + " " + text[b : b + NEAR // 2]).lower()))
    context = 1 if around & _CUES[kind] else -1 if around & _AGAINST else 0
    return _form(kind, span), _gazetteer(kind, span), context, _edges(text, a, b)


def pattern_code(text: str, kind: int, a: int, b: int) -> int:
    """Kind, votes and shape as one number below ``len(KINDS) * PATTERNS``."""
    code = kind
    for vote in votes(text, kind, a, b):
        code = code * 3 + vote + 1
    digits = sum("0" <= c <= "9" for c in text[a:b])
    code = code * DIGIT_BUCKETS + min(digits // 4, DIGIT_BUCKETS - 1)
    return code * SEPARATORS + any(c in " -()." for c in text[a:b])


def unpack_code(code: int) -> tuple[int, list[int], int, int]:
    """(kind, votes, digits bucket, has separators) of a pattern."""
    code, separators = divmod(code, SEPARATORS)
    code, digits = divmod(code, DIGIT_BUCKETS)
    signs = []
    for _ in LABELERS:
        code, vote = divmod(code, 3)
        signs.append(vote - 1)
    return code, signs[::-1], digits, separators


def estimate(signs: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of each vote pattern, each labeler's table of P(vote | class)).

    Votes are independent given the class. Begun from the majority; every cell is smoothed by one
    observation, so a vote never seen decides nothing.
    """
    choices = signs[:, :, None] == np.array([-1, 0, 1])  # pattern, labeler, vote
    p = 1 / (1 + np.exp(-signs.sum(axis=1).astype(float)))
    table = np.empty((2, signs.shape[1], 3))
    for _ in range(rounds):
        weight = np.stack([1 - p, p]) * counts
        table = np.einsum("cp,plv->clv", weight, choices) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        score = np.log(prior)[:, None] + np.einsum("plv,clv->cp", choices, np.log(table))
        p = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
    return p, table


def _features(codes: Sequence[int]) -> np.ndarray:
    rows = []
    for code in codes:
        kind, signs, digits, separators = unpack_code(code)
        row = [float(kind == k) for k in range(len(KINDS))]
        row += [float(s == v) for s in signs for v in (-1, 1)]
        row += [float(digits == d) for d in range(DIGIT_BUCKETS)] + [float(separators)]
        rows.append(row)
    return np.array(rows).reshape(len(rows), len(KINDS) + 2 * len(LABELERS) + DIGIT_BUCKETS + 1)


def train(codes: Sequence[int], counts: Sequence[int]) -> dict[int, float]:
    """Probability of personal data for every pattern that occurs.

    Labelers are judged for each kind by itself; the classifier, a ridge-regularised logistic
    regression fitted by Newton's method, shares votes and shape over the kinds.
    """
    if not len(codes):
        return {}
    weight = np.array(counts, float)
    unpacked = [unpack_code(c) for c in codes]
    kinds = np.array([u[0] for u in unpacked])
    signs = np.array([u[1] for u in unpacked])
    target = np.zeros(len(codes))
    for kind in set(kinds.tolist()):
        own = kinds == kind
        target[own] = estimate(signs[own], weight[own])[0]
    x = _features(codes)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (target - p)) - w
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + np.eye(len(w)), gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return dict(zip(codes, (1 / (1 + np.exp(-x @ w))).tolist(), strict=True))


def _scan(texts: pa.Array) -> pa.Array:
    base_ends, more_ends = [0], [0]
    base: list[tuple] = []
    more: list[tuple] = []
    for value in texts:
        text = value.as_py() or ""
        spans = base_spans(text)
        base += [(*s, pattern_code(text, *s)) for s in spans]
        more += [(*s, pattern_code(text, *s)) for s in candidate_spans(text, spans)]
        base_ends.append(len(base))
        more_ends.append(len(more))
    names = ["kind", "start", "end", "code"]

    def lists(rows: list[tuple], ends: list[int]) -> pa.Array:
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        made = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made)

    return pa.StructArray.from_arrays([lists(base, base_ends), lists(more, more_ends)], ["base", "more"])


_SPANS = "array<struct<kind: bigint, start: bigint, end: bigint, code: bigint>>"


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, base, spans.

    ``base`` holds the certain spans and ``spans`` these with the candidates whose probability is at
    least ``threshold``, both as (kind, start, end), by kind, then start; positions are code points,
    ends exclusive. NULL texts count as empty; NULL and repeated keys are rows like any other; other
    columns are ignored. Without any candidate nothing is added.
    """
    scan = F.arrow_udf(_scan, returnType=f"struct<base: {_SPANS}, more: {_SPANS}>")
    rows = docs.select(F.col(key).alias("doc_id"), scan(F.col(text)).alias("found"))
    rows = stored(rows.select("doc_id", "found.base", "found.more"), "pii-spans")
    every = rows.select(F.explode(F.transform(F.concat("base", "more"), lambda s: s["code"])).alias("code"))
    patterns = every.groupBy("code").count().collect()  # bounded: one row per pattern
    chances = train([r["code"] for r in patterns], [r["count"] for r in patterns])
    accepted = sorted(code for code, p in chances.items() if p >= threshold)
    table = F.array(*map(F.lit, accepted)).cast("array<bigint>")
    added = F.filter("more", lambda s: F.array_contains(table, s["code"]))
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return rows.select(
        "doc_id", bare(F.col("base")).alias("base"), F.array_sort(bare(F.concat("base", added))).alias("spans")
    )


def joined(spans: str) -> Column:
    """kind:start:end of the spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"].cast("int") + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and a checksum of the certain spans, and all spans."""
    kinds = F.col("base.kind")
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, place))).cast("bigint").alias(f"n_{name}")
        for place, name in enumerate(KINDS[:BASE_KINDS])
    ]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
