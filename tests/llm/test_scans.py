"""Secrets, quality and personal data: one text at a time, so rows are compared with plain Python."""

import random
import time
import re

import brute
import numpy as np
import pytest

from lexloom.llm import pii, quality, secrets

PIECES = [
    "token", "Secret", "api_key", "APIKEY", "password", "passwd", "=", ":", " ", "'", '"', "abcdefgh", "12345678", "x=y",
    "AKIA", "ABCDEFGH1234", "deadbeef" * 4, "0123456789abcdef", "é", "🙂", "\n", "K", "ſecret", ".", "-", "zz",
]


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_trigram_queries_are_met_by_every_match():
    rnd = random.Random(1)
    for rule in secrets.RULES:
        query = secrets.trigram_query(rule.pattern)
        for _ in range(400):
            text = "".join(rnd.choice(PIECES) for _ in range(8))
            if re.search(rule.pattern, text, re.ASCII):
                low = text.lower()
                assert not query or any(all(t in low for t in clause) for clause in query)
    assert secrets.trigram_query(r"[0-9a-f]+") == []
    assert secrets.trigram_query(r"ab?cde") == [frozenset({"abc", "bcd", "cde"}), frozenset({"acd", "cde"})]


def test_secrets_on_random_texts(spark, odd_docs):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30))) for _ in range(600)]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for docs in (made, odd_docs):
        found = secrets.digest(secrets.scan_secrets(docs)).collect()
        got = sorted((str(r.doc_id), [r.n_assign, r.n_access, r.n_hex], r.base_sha256) for r in found)
        want = sorted((str(d), *brute.secrets_base(t)[:2]) for d, t in rows_of(docs))
        assert got == want


def test_secret_of_a_further_rule(spark):
    docs = spark.createDataFrame([(1, "key ghp_" + "z1" * 18 + " end")], "doc_id bigint, text string")
    assert secrets.digest(secrets.scan_secrets(docs)).first().spans == "github:4:44"


def test_quality_measures(spark, odd_docs):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("a b cé # \n x".split(" ")) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for docs in (made, odd_docs):
        rows = quality.judge_quality(docs).collect()
        names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
        for r in rows:
            assert tuple(r[n] for n in names) == brute.quality_base(r.text)
            assert not (r.kept and r.base_failed)
    assert "spans" in quality.judge_quality(odd_docs).columns


def test_quality_coverage_of_ngrams_and_lines():
    text = "one two three four five six\nown words here\none two three four five six\n".encode()
    *_, line_chars, dup_chars, shares = quality.measure(text, (4, 6))
    assert (line_chars, dup_chars) == (68, 27)
    assert shares == [44, 44]
    random_words = " ".join(str(x) for x in np.random.default_rng(1).integers(0, 10**9, 500)).encode()
    assert quality.measure(random_words, (4, 6))[-1] == [0, 0]


def test_personal_data(spark, odd_docs):
    rnd = random.Random(4)
    pieces = ["a@b.co", "x.y@z", "@", ".", "1.2.3.4", "999.1.1.1", "0001.2.3.4", "+1 (555) 123-4567", "+12", "4111111111111111",
              "4111 1111-1111 1111", " ", "-", "\n", "é", "1", "22", "abc", "%", "(", ")"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25))) for _ in range(800)]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for docs in (made, odd_docs):
        got = pii.digest(pii.find_pii(docs)).collect()
        got = sorted((str(r.doc_id), [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) for r in got)
        assert got == sorted((str(d), *brute.pii_base(t)[:2]) for d, t in rows_of(docs))


@pytest.mark.parametrize("text", [
    "1" * 1_000_000, "0" * 400_000 + ".1.2.3 " + "0." * 300_000, "1." * 500_000, "12 345 6789-" * 80_000, "+1 " * 300_000, "+1" + " " * 500_000,
    "a" * 1_000_000, "a@" * 500_000, "a.b@c.d " * 120_000, "4111 1111 1111 1111," * 50_000, "555-010-9999 " * 80_000, "A1" * 500_000, "1:" * 500_000,
])
def test_a_million_characters_in_seconds(text):
    start = time.time()
    base = pii.base_spans(text)
    more = pii.candidate_spans(text, base)
    spans = sorted((a, b) for _, a, b in more)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    assert time.time() - start < 10


def test_numbers_whose_check_sum_fails_are_candidates():
    text = "card 4111 1111 1111 1112 and 4111111111111111, x12345678901234567"
    base = pii.base_spans(text)
    assert [text[a:b] for k, a, b in base if k == 2] == ["4111111111111111"]
    assert [(k, text[a:b]) for k, a, b in pii.candidate_spans(text, base)] == [(2, "4111 1111 1111 1112")]


def test_weak_labels_decide_on_candidates(spark):
    """Held-out accuracy: numbers that follow phone cues against the same form after version cues."""
    rnd = random.Random(5)

    def text(private):
        number = f"{rnd.randint(200, 999)}-{rnd.randint(100, 999)}-{rnd.randint(1000, 9999)}"
        return f"please call me on the phone {number} today" if private else f"order serial 7{number}7x in version list"

    truth = [rnd.random() < 0.5 for _ in range(400)]
    docs = spark.createDataFrame([(i, text(t)) for i, t in enumerate(truth)], "doc_id bigint, text string")
    got = {r.doc_id: "phone" in r.spans for r in pii.digest(pii.find_pii(docs, threshold=0.5)).collect()}
    right = sum(got[i] == t for i, t in enumerate(truth))
    assert right >= 0.95 * len(truth)


def test_rare_kinds_weigh_by_their_counts_beside_frequent_ones():
    """At the optimum a kind's weighted residual is its own ridge term, whatever the size of the corpus."""
    rng = np.random.default_rng(2)
    counts = {}
    for kind, total in ((0, 1e10), (3, 1e10), (4, 1000), (5, 1000)):
        for _ in range(40):
            code = kind
            for vote in rng.integers(0, 3, len(pii.LABELERS)):
                code = code * 3 + int(vote)
            code = (code * pii.DIGIT_BUCKETS + int(rng.integers(6))) * pii.SEPARATORS + int(rng.integers(2))
            counts[code] = counts.get(code, 0) + max(1, int(total * rng.random() / 20))
    codes = sorted(counts)
    made = pii.train(codes, [counts[c] for c in codes])
    for kind in (0, 3, 4, 5):
        own = [c for c in codes if pii.unpack_code(c)[0] == kind]
        weight = np.array([counts[c] for c in own], float)
        target = pii.estimate(np.array([pii.unpack_code(c)[1] for c in own]), weight)[0]
        assert abs(float(weight @ (target - np.array([made[c] for c in own])))) < 20


def test_labelers_are_judged_without_labels():
    rng = np.random.default_rng(6)
    truth = rng.random(4000) < 0.4
    accuracy = (0.95, 0.8, 0.7)
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) * 2 - 1 for a in accuracy], axis=1)
    signs, counts = np.unique(votes, axis=0, return_counts=True)
    _, table = pii.estimate(signs, counts)
    for labeler, a in enumerate(accuracy):
        assert abs(table[1, labeler, 2] - a) < 0.05


@pytest.mark.parametrize("run", [
    lambda d: secrets.digest(secrets.scan_secrets(d)), quality.judge_quality, lambda d: pii.digest(pii.find_pii(d)),
])
def test_empty_tables(no_docs, run):
    assert run(no_docs).count() == 0
