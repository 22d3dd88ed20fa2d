"""Spelling variants, the filter audit and language identification against plain Python."""

import random
import re
import time
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import audit, language, queries, spelling

# ---------------------------------------------------------------- spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def brute_variants(words):
    form, out = {}, {}
    for w, n in words.items():
        near = [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * n:
            form[w] = best
        out[w] = (n, len(near))
    rows = set()
    for w, (n, n_near) in out.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, n_near, words[form[w]] if w in form else None))
    return rows


def variants(docs):
    found = spelling.group_variants(docs).select("word", "form", "root", "n", "n_near", "form_n")
    return [tuple(r) for r in found.collect()]


def mutated(rnd, word):
    at, c = rnd.randrange(len(word)), rnd.choice("abcéÿ×")
    return rnd.choice([word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]])


def variant_rows(seed, size=400):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(5, 16))) for _ in range(40)]
    words = []
    for w in base:
        for times in (rnd.choice([2, 30, 400]), 30, 2, rnd.choice([1, 3]), rnd.choice([1, 25]), 2):
            words += [w] * times
            w = mutated(rnd, w)
    rnd.shuffle(words)
    per = len(words) // size + 1
    return [(i, " ".join(x.upper() if rnd.random() < 0.1 else x for x in words[i * per : (i + 1) * per])) for i in range(size)]


@pytest.mark.parametrize("seed", range(2))
def test_variants(spark, seed):
    rows = variant_rows(seed)
    got = variants(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = brute_variants(brute_words(rows))
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)


def test_variants_in_tiles(spark, monkeypatch):
    """Groups beyond a tile meet tile by tile, blocks of a few rows at a time."""
    for name, value in (("TILE", 3), ("BLOCK", 4)):
        monkeypatch.setattr(spelling, name, value)
    rnd = random.Random(5)
    words = {"aaaa" + "".join(rnd.choice("ab") for _ in range(rnd.randint(3, 5))) for _ in range(60)}
    table = spark.createDataFrame([(w, rnd.randint(2, 9)) for w in sorted(words)], "word string, n bigint")
    got = {(r.word, r.n_near, r.best) for r in spelling.near_words(table).collect()}
    n = {r.word: r.n for r in table.collect()}
    want = set()
    for w in words:
        near = [x for x in words if one_edit(w, x)]
        want.add((w, len(near), min(near, key=lambda x: (-n[x], x), default=None)))
    assert got == want


def test_query_against_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op11_spelling(spark, data).collect()]
    assert set(got) == brute_variants(brute_words(rows)) and len(got) == len(set(got))


def test_variants_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert set(variants(odd_docs)) == brute_variants(brute_words(rows))
    assert variants(no_docs) == []


def test_very_long_words(spark):
    """Two runs of half a million letters, one letter apart, beside a text of a million short words."""
    rnd = random.Random(1)
    long = "".join(rnd.choice("abcdefgh") for _ in range(500_000))
    texts = [long, long, long[:250_000] + "z" + long[250_000:], long[:250_000] + "z" + long[250_000:], "ab " * 1_000_000]
    # doc_ids whose hash deletes nothing
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    start = time.time()
    got = {(len(r[0]), r[4]) for r in variants(docs)}
    assert got == {(len(w), 1) for w in brute_words(enumerate(texts))} and len(got) == 2
    assert time.time() - start < 90


def test_gram_distances_are_exact():
    words = [b"aaaa" * 3000, b"aaaa" * 3000 + b"b", b"aaaa" * 2999 + b"bbbb"]
    block = spelling.Block(words)
    assert spelling.squared_distances(block.counts, block.counts).astype(int).tolist() == [[0, 1, 32], [1, 0, 25], [32, 25, 0]]


# ---------------------------------------------------------------- audit


def brute_audit(rows, labels):
    """rows (doc_id, text, source), labels (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    docs = []
    for d, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(w) < 50:
            fails.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if d is not None and least[t] < d:
            fails.add("E")
        docs.append((s or "", fails, d in good, d in toxic))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                redundant = sum(x in d[1] for d in own) - len(gone)
                shapley[part, x] += len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(d[1] == {x} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(docs, labels):
    return [tuple(r) for r in audit.audit_filters(docs, labels).select(*AUDIT).collect()]


def test_lehmer_ranks_and_edges():
    every = audit.orders("ABCDE")
    assert every == sorted(every) and len(every) == 120
    assert all(audit.lehmer_rank(o, "ABCDE") == i for i, o in enumerate(every))
    step_of = {}
    for mask, step, rank, sign in audit.removal_edges("ABCDE"):
        for r in range(rank, 120):
            step_of[mask, step, r] = step_of.get((mask, step, r), 0) + sign
    for mask in range(1, 32):
        failed = {x for i, x in enumerate("ABCDE") if mask >> i & 1}
        for r, order in enumerate(every):
            first = next(s for s, x in enumerate(order, 1) if x in failed)
            assert [step_of.get((mask, s, r), 0) for s in range(1, 6)] == [int(s == first) for s in range(1, 6)]


def test_audit(spark):
    rnd = random.Random(3)
    texts = [None, "", "# short", "A B C " * 30, " ".join(f"w{i}" for i in range(80)), "Ab|c " * 60, " ".join(f"W{i}" for i in range(60))]
    rows = [(rnd.choice([None, *range(40)]), rnd.choice(texts), rnd.choice([None, "", "a", "b", "c'd"])) for _ in range(300)]
    labels = [(rnd.choice([None, *range(60)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(70)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("part", F.lit("x")).withColumn("mask", F.lit(1))
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("y"))
    got = audited(docs, marks)
    assert set(got) == brute_audit(rows, labels) and len(got) == len(set(got)) == 4 * 600


def test_audit_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 1)], "doc_id bigint, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    assert set(audited(odd_docs, labels)) == brute_audit(rows, [tuple(r) for r in labels.collect()])
    assert set(audited(odd_docs, labels.filter("1 = 0"))) == brute_audit(rows, [])
    assert audited(no_docs, labels) == []


# ---------------------------------------------------------------- language


def test_grams_and_kernel():
    def plain(text):
        text = "".join(c if c.isalpha() or ord(c) >= 0x300 else " " for c in text.lower())
        return {text[i : i + n] for n in language.LENGTHS for i in range(len(text) - n + 1)}

    texts = ["Ab, ab1c é", "xyz", "abc abc", "Ωmega 漢字", "a"]
    for t in texts:
        assert len(language.grams(t)) == len(plain(t))
    model = language.fit([("p", texts[0]), ("p", texts[2]), ("q", texts[1])])
    kernel = model.kernel([language.grams(t) for t in texts])
    for row, t in zip(kernel, texts):
        for value, mark in zip(row, [texts[0], texts[2], texts[1]]):
            a, b = plain(t), plain(mark)
            assert value == pytest.approx(len(a & b) / (len(a) * len(b)) ** 0.5)


def test_nystroem_with_all_landmarks_is_kernel_ridge():
    """With every row a landmark the model is kernel ridge regression on centred features."""
    rnd = random.Random(2)
    rows = [(lang, "".join(rnd.choice(letters) for _ in range(30))) for lang, letters in (("p", "abcd "), ("q", "cdef "), ("r", "xyza ")) for _ in range(6)]
    model = language.fit(rows, landmarks=18, ridge=0.01)
    sets = [language.grams(t) for _, t in rows]
    k = model.kernel(sets)
    centred = np.eye(18) - np.full((18, 18), 1 / 18)
    y = np.where(np.array([lang for lang, _ in rows])[:, None] == np.array(model.languages), 1.0, -1.0)
    alpha = np.linalg.solve(centred @ k @ centred + 0.01 * 18 * np.eye(18), centred @ y)
    want = centred @ k @ centred @ alpha + y.mean(axis=0)
    assert np.allclose(k @ model.weights + model.bias, want, atol=1e-6)


def test_long_texts_by_chunks(monkeypatch):
    text = "".join(random.Random(4).choice("abcdé ") for _ in range(5000))
    whole = language.grams(text)
    monkeypatch.setattr(language, "CHUNK", 100)
    assert (language.grams(text) == whole).all()


def test_held_out_accuracy(spark):
    """On held-out documents of the larger supplied table, whose labels the fit never sees."""
    folder = "/root/testdata/sf0.01"
    named = queries.op13_language(spark, folder).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in named if r.held_out]
    assert len(named) == len(docs) and {r.doc_id for r in held} == {d for d in docs if zlib.crc32(str(d).encode()) % 5 == 0}
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in named)


def test_predictions_read_the_text_alone(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    moved = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "zz").otherwise(F.col("lang")))
    a = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(moved.repartition(5)).collect()}
    assert a == b and "zz" not in {x for x, _ in b.values()}


def test_languages_of_odd_rows(spark, odd_docs, no_docs):
    odd = odd_docs.withColumn("lang", F.when(F.col("doc_id") != 3, F.lit("en"))).withColumn("score", F.lit("s"))
    rows = language.identify(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.lang_pred, r.score > 0) == (("en", True) if any(map(str.isalpha, r.text or "")) else ("und", False))
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    unknown = language.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}
    assert language.identify(no_docs.withColumn("lang", F.lit("en"))).count() == 0
