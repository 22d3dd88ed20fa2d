"""Mixing, sharding, search, similarity and line runs against plain Python."""

import math
import random
from fractions import Fraction

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lexloom.llm import components, jaccard, linededup, mixing, sharding, topk


def spark_hash(*values):
    seed = 42
    for v in values:
        size = 4 if isinstance(v, np.int32) else 8
        seed = xxhash.xxh64_intdigest(int(v).to_bytes(size, "little", signed=True), seed)
    return seed


def test_rendezvous(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("ab é").alias("text"))
    rows = sharding.shard_records(docs, [1.0] * 7, [1.0] * 8).collect()

    def shard(key, n):
        scores = [1 / -math.log(((spark_hash(key, np.int32(i)) >> 11) + 0.5) / 2**53) for i in range(n)]
        return scores.index(max(scores))

    for r in rows:
        assert (r.shard, r.grown_shard) == (shard(r.doc_id, 7), shard(r.doc_id, 8))
        assert r.grown_shard in (r.shard, 7)
        assert (r["size"], r.law) == (5 + 16, "key")
    for i in range(7):
        assert sorted(r.slot for r in rows if r.shard == i) == list(range(sum(r.shard == i for r in rows)))


def test_weighted_shards(spark):
    counts = spark.range(20000).select(sharding.shard_of(F.col("id"), [1.0, 3.0, 0.0]).alias("s")).groupBy("s").count()
    counts = {r.s: r["count"] for r in counts.collect()}
    assert set(counts) == {0, 1} and abs(counts[1] / counts[0] - 3) < 0.2
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), [0.0])


def test_shards_of_odd_rows(spark, odd_docs, no_docs):
    rows = sharding.shard_records(odd_docs, [1.0] * 3, [1.0] * 4).collect()
    assert len(rows) == odd_docs.count()
    for i in range(3):
        assert sorted(r.slot for r in rows if r.shard == i) == list(range(sum(r.shard == i for r in rows)))
    assert {(r["size"], r.text_crc32) for r in rows if r.doc_id in (3, 4)} == {(16, 0)}
    assert sharding.shard_records(no_docs, [1.0], [1.0, 1.0]).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_seats(spark, seed):
    rnd = random.Random(seed)
    names = sorted(f"s{i}" for i in range(rnd.randint(1, 12)))
    sizes = [rnd.choice([0, 1, 5, 100, 5000, rnd.randint(0, 10**6)]) for _ in names]
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size bigint")
    rows = mixing.water_levels(table, mixing.WEIGHTS, 1.5, 2.0).orderBy("rank").collect()
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(names))]
    assert [r.target for r in rows] == pytest.approx(brute.poured(sizes, weights, 1.5, 2.0))
    votes = [rnd.choice([0, 1, 7, 7, 100, rnd.randint(1, 5000)]) for _ in range(rnd.randint(1, 15))]
    seats = rnd.choice([0, 1, 3, 50, 300]) if any(votes) else 0
    cells = spark.createDataFrame([(i, float(v), seats) for i, v in enumerate(votes)], "cell int, votes double, seats bigint")
    got = {r.cell: r.quota for r in mixing.apportion(cells, ["cell"], [], "votes", "seats").collect()}
    assert [got[i] for i in range(len(votes))] == brute.sainte_lague(votes, seats)


def test_mix(spark):
    rnd = random.Random(7)
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(rnd.randint(0, 90))), rnd.choice(["a", "a", "a", "b", None])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    plan = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    words = {i: t.split() for i, t, _ in rows}
    for s in ("a", "b", None):
        own = [r for r in plan if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= mixing.BLOCK * (mixing.SHARDS + 1)
        assert own[0].source_size == sum(len(words[r.doc_id]) for r in own)
    assert all(r["size"] == len(words[r.doc_id]) and r.taken <= 2 * r["size"] for r in plan)
    made = {}
    for r in mixing.mixed_documents(docs).collect():
        made.setdefault(r.doc_id, []).extend(r.text.split())
    for r in plan:
        assert len(made.get(r.doc_id, [])) == r.taken
        assert set(made.get(r.doc_id, [])) <= set(words[r.doc_id])


def test_mix_of_odd_rows(spark, odd_docs, no_docs):
    plan = mixing.mix(odd_docs).collect()
    assert len(plan) == odd_docs.count()
    taken = sum(r.taken for r in plan)
    made = mixing.mixed_documents(odd_docs)
    assert made.columns == odd_docs.columns
    assert sum(len(r.text.split()) for r in made.collect()) == taken
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0


def top_rows(rows, k):
    good = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i, q in good:
        if i % 3 == 0:
            scored = sorted((-int(q @ v), j) for j, v in good if j != i and len(v) == len(q))[:k]
            want += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    return sorted(want)


@pytest.mark.parametrize("seed", range(3))
def test_top_k(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=6) * (0, 0.3, 1000.0)[seed % 3]).round(2).tolist()) for i in range(240)]
    rows += [(500 + i, rows[7][1]) for i in range(20)]  # ties
    rows += [(600, None), (601, []), (602, [1.0, None]), (603, [float("nan")] * 6), (604, [float("inf")] * 6), (605, [1.0, 2.0]), (606, [0.5, 0.1])]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit("x"))
    got = topk.top_k(docs.repartition(5), F.col("vec_id") % 3 == 0, block=64, query_block=16, bits=3)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())
    assert got == top_rows(rows, 5)


@pytest.mark.parametrize("sizes", [(1.0, 1e5), (1e6, 1e9), (1.0, 1e13, 1e30), (1e300, 1e-3, 1.7e308)])
def test_top_k_of_large_components(spark, sizes):
    """Finite components of every size count, alone or among small ones."""
    rng = np.random.default_rng(1)
    rows = [(i, (rng.uniform(-1, 1, size=4) * (sizes[i % len(sizes)] if i % 5 == 0 else 1.0)).tolist()) for i in range(150)]
    rows += [(200, rows[0][1]), (201, rows[10][1]), (202, [-x for x in rows[0][1]])]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.top_k(docs.repartition(3), F.col("vec_id") % 3 == 0, block=64, query_block=16, bits=3)
    whole = {i: [math.floor(256 * Fraction(x)) for x in v] for i, v in rows}
    want = []
    for i, q in whole.items():
        if i % 3 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole.items() if j != i)[:5]
            want += [(i, rank, j, -s if -(2**63) <= -s < 2**63 else None) for rank, (s, j) in enumerate(scored, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == sorted(want)


def test_top_k_of_repeated_keys_and_nothing(spark):
    rows = [(3, [1.0]), (3, [2.0]), (4, [1.0]), (4, [1.0]), (None, [9.0])]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(docs, F.col("vec_id") == 3, k=3).collect())
    assert got == sorted([(3, 1, 4, 65536), (3, 2, 4, 65536), (3, 1, 4, 131072), (3, 2, 4, 131072)])
    assert topk.top_k(docs.filter("1 = 0"), F.col("vec_id") == 3).count() == 0


def test_crossing_counts_a_pair_whole_whichever_side_is_outside(spark):
    """Groups 1 and 2 share 92 of 100 elements, as needed at 85 %: eight of them in the prefixes, where
    the larger component is now that of 1, now that of 2."""
    shared = [(e, g, 100, 8 + e) for e in range(8) for g in (1, 2)]
    shared += [(e, 3 + e % 2, 100, 40 + e // 2) for e in range(8)]  # 3 goes with 1 and 4 with 2
    members = [(1, 1, 1, 1), (2, 2, 1, 2), (3, 3, 1, 1), (4, 4, 1, 2)]
    classes = [(i, [0] * (jaccard.SIGNATURE_BITS // 64)) for i in range(1, 5)]
    for order in (1, -1):  # either of the two may lead at the last shared element
        found = jaccard._crossing(
            spark.createDataFrame([(order * e, *r) for e, *r in shared], "element bigint, gid bigint, n bigint, pos int"),
            spark.createDataFrame(members, "gid bigint, cid bigint, size bigint, comp bigint"),
            spark.createDataFrame(classes, "cid bigint, signature array<bigint>"),
            85,
        )
        assert (1, 2) in {(r.a, r.b) for r in found.collect()}


def near_copies(seed, n=150):
    rnd = random.Random(seed)
    base = [[rnd.choice("abcdefgh") + str(rnd.randint(0, 30)) for _ in range(rnd.choice([3, 8, 40, 60]))] for _ in range(12)]
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            words[rnd.randrange(len(words))] = f"e{rnd.randint(0, 9)}"
        if rnd.random() < 0.3:
            words += passage
        rows.append((i, (" " if rnd.random() < 0.9 else "\t").join(words).replace("a", rnd.choice("aA"))))
    return rows


@pytest.mark.parametrize("seed, words, percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_similar_documents(spark, seed, words, percent):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs, words, percent).collect()}
    want = brute.components(rows, words, percent)
    assert [got[i] for i, _ in rows] == want
    kept = sorted(r.doc_id for r in jaccard.keep_one(docs, words, percent).collect())
    assert kept == sorted({c for _, c in want})


def test_similar_documents_of_odd_rows(spark, odd_docs, no_docs):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.similar_documents(odd_docs, 4, 85).collect())
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = sorted((str(d), n, str(c)) for (d, _), (n, c) in zip(rows, brute.components(rows, 4, 85)))
    assert got == want
    assert jaccard.similar_documents(no_docs).count() == 0
    kept = jaccard.keep_one(odd_docs, 4, 85)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted("1 3 4 5 6 8 8 9 None".split())


def test_one_row_of_those_that_repeat_key_and_text(spark):
    """Of a third of all rows with one key and text, and of other repeated ones, a single row each stays."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(7, text, f"s{i}") for i in range(50)] + [(i, f"{text} {i} " * 3, "t") for i in range(100, 130)] + [(101, f"{text} 101 " * 3, "a")]
    rows += [(3, "", "x"), (3, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = [tuple(r) for r in jaccard.keep_one(docs, 5, 80).collect()]
    assert [r for r in kept if r[0] == 7] == [(7, text, "s0")]
    assert [r[2] for r in kept if r[0] == 101] in (["a"], []) and len([r for r in kept if r[0] == 3]) == 2
    assert len({r[:2] for r in kept if r[1]}) == len([r for r in kept if r[1]])


def test_components_of_a_chain(spark):
    order = list(range(60))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(a, b) for a, b in zip(order, order[1:]) if a % 20], "a bigint, b bigint")
    got = {r.node: r.label for r in components.components(links).collect()}
    label, low = {}, []
    for a in order:
        low.append(a)
        if not a % 20 or a == order[-1]:
            label |= dict.fromkeys(low, min(low))
            low = []
    assert all(label[n] == x for n, x in got.items())


@pytest.mark.parametrize("min_words", [1, 4, 7])
def test_line_runs(spark, min_words):
    rnd = random.Random(min_words)
    lines = ["a", "b c", "d", "e f g", "h i", "", "  ", "j k l m", " "]
    rows = [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 14)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute.dedup_lines(rows, min_words)
    for r in linededup.dedup_lines(docs, min_words).collect():
        places = [x for i in range(0, len(r.deleted), 2) for x in range(*r.deleted[i : i + 2])]
        assert (r.text, places) == want[r.doc_id]


def test_line_runs_of_odd_rows(spark, odd_docs, no_docs):
    made = linededup.dedup_lines(odd_docs)
    assert made.columns == [*odd_docs.columns, "n_lines", "deleted"]
    rows = made.collect()
    assert len(rows) == odd_docs.count()
    texts = {r.doc_id: r.text for r in rows if r.doc_id in (1, 2, 3, 4, 6, 7)}
    assert texts[3] is None and texts[4] == "" and texts[7] == ""
    assert texts[1].startswith("the same") and texts[2] == "an own line of words two"
    assert linededup.dedup_lines(no_docs).count() == 0
