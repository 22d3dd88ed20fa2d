import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.operators import cooccur, lattice, order, spacing, subword, tokenizers, vocab, wordscore
from lexloom.operators.lookup import lookup
from lexloom.plans import catalog
from lexloom.session import BROADCAST_CONF


def corpus(spark, *lines):
    return spark.createDataFrame([(0, i, s) for i, s in enumerate(lines)], "doc_id bigint, line_no int, line string")


def token_frame(spark, *lines):
    return corpus(spark, *lines).withColumn("tokens", F.split("line", " "))


def in_order(df, col="tokens"):
    return [r[col] for r in df.orderBy("doc_id", "line_no").collect()]


def test_vocab(spark):
    counted = vocab.vocab_count(token_frame(spark, "a b a c b a"), 2).collect()
    assert [(r.word, r.cnt) for r in counted] == [("a", 3), ("b", 2)]
    full = vocab.lm_vocab(token_frame(spark, "a b a")).orderBy("id").collect()
    assert [r.token for r in full] == ["<S>", "</S>", "<UNK>", "a", "b"]


def test_ordinals_and_shards(spark):
    df = spark.createDataFrame([(1, i, str(i)) for i in range(5)], "doc_id bigint, line_no int, line string")
    shards = order.shard_lines(df, 2).orderBy("line_no").collect()
    assert [r.shard for r in shards] == [0, 0, 1, 1, 2]
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "d\ne")], "doc_id bigint, text string")
    made = order.shard_documents(docs, 2).orderBy("ordinal").collect()
    assert [(r.line, r.shard) for r in made] == [("a", 0), ("b", 0), ("c", 1), ("d", 1), ("e", 2)]


def test_running_total_of_one_huge_group(spark):
    df = spark.range(2000).select((F.col("id") % 50 < 49).cast("int").alias("g"), "id", F.lit(2).alias("v"))
    got = order.running_total(df, ["id"], "v", "before", ["g"]).collect()
    want, seen = {}, Counter()
    for i in range(2000):
        g = int(i % 50 < 49)
        want[i] = seen[g]
        seen[g] += 2
    assert {r.id: r.before for r in got} == want


def test_scores(spark):
    prefixes = spark.createDataFrame(
        [("a", 8), ("ab", 4), ("abc", 2), ("abd", 2)], "word string, freq bigint"
    )
    cohesion = {r.word: r.cohesion_forward for r in wordscore.cohesion_forward(prefixes).collect()}
    assert cohesion["a"] == 0 and cohesion["ab"] == 0.5 and cohesion["abc"] == pytest.approx(0.5)
    entropy = {r.word: r.right_branching_entropy for r in wordscore.right_branching_entropy(prefixes).collect()}
    assert entropy["ab"] == pytest.approx(math.log(2))
    scored = {r.word: r for r in wordscore.scores_from_prefixes(prefixes, 1).collect()}
    assert scored["ab"].score == pytest.approx(1.0) and scored["abc"].right_branching_entropy == 0


def test_l_tokens(spark):
    scores = spark.createDataFrame([("ab", 1.0), ("abc", 2.0)], "word string, score double")
    lines = corpus(spark, "abcd xy abz", "")
    assert in_order(tokenizers.l_tokenize(lines, scores)) == [["abc", "d", "xy", "ab", "z"], []]
    assert in_order(tokenizers.l_tokenize(corpus(spark, "abcd"), scores.filter("false"))) == [["abcd"]]
    tie = spark.createDataFrame([("ab", 1.0), ("abc", 1.0)], "word string, score double")
    assert in_order(tokenizers.l_tokenize(corpus(spark, "abcd"), tie)) == [["abc", "d"]]


def test_lexicon(spark):
    base = spark.createDataFrame([("x", "NNG"), ("y", "NNG")], "word string, tag string")
    user = spark.createDataFrame([("x", "NNP")], "word string, tag string")
    merged = tokenizers.merge_lexicon(base, user)
    assert sorted((r.word, r.tag) for r in merged.collect()) == [("x", "NNP"), ("y", "NNG")]
    tagged = tokenizers.lexicon_tokenize(token_frame(spark, "xy xz q x"), merged)
    assert [tuple(p) for p in tagged.first().tagged] == [
        ("x", "NNP"), ("y", "NNG"), ("x", "NNP"), ("z", "UNK"), ("q", "UNK"), ("x", "NNP")
    ]


def test_small_lexicon_is_applied_in_the_task(spark, monkeypatch, request):
    """Tokens are neither collected nor looked up where the lexicon fits; joins tag them alike."""
    base = spark.createDataFrame([("a", "J"), ("ab", "N"), ("cd", None), ("é🙂", "N"), (None, "N")], "word string, tag string")
    lines = token_frame(spark, "abcd ab abx xab a cdab cd é🙂a", "").unionByName(
        spark.createDataFrame([(0, 2, None, ["ab", None, ""]), (0, 3, None, None)], "doc_id bigint, line_no int, line string, tokens array<string>")
    )
    given = tokenizers.lookup
    monkeypatch.setattr(tokenizers, "lookup", None)
    got = in_order(tokenizers.lexicon_tokenize(lines, base), "tagged")
    want = [("ab", "N"), ("cd", "UNK"), ("ab", "N"), ("ab", "N"), ("x", "UNK"), ("xab", "UNK"), ("a", "J"), ("cd", None), ("ab", "N"), ("cd", None)]
    assert [tuple(p) for p in got[0]] == [*want, ("é🙂", "N"), ("a", "J")]
    assert [tuple(p) for p in got[2]] == [("ab", "N"), (None, "UNK"), ("", "UNK")] and got[3] is None
    monkeypatch.setattr(tokenizers, "lookup", given)
    request.getfixturevalue("joins_only")
    assert in_order(tokenizers.lexicon_tokenize(lines, base), "tagged") == got


def test_tokenizer_registry(spark):
    lines = corpus(spark, " a1 b ")
    assert in_order(tokenizers.tokenize(lines, "whitespace")) == [["a", "1", "b"]]

    class Letters:
        def morphs(self, text):
            return [c for c in text if c != " "]

        def pos(self, text):
            return [(c, "L") for c in self.morphs(text)]

    tokenizers.register_analyzer("letters", Letters)
    assert in_order(tokenizers.tokenize(lines, "letters", pos=True)) == [["a/L", "1", "/L", "b/L"]]
    before = tokenizers.DEFAULT_TOKENIZER
    tokenizers.set_default("letters")
    assert in_order(tokenizers.tokenize(lines, "no such name")) == [["a", "1", "b"]]
    tokenizers.set_default(before)


def test_wordpiece_and_ids(spark):
    pieces = spark.createDataFrame([("un",), ("##able",), ("[UNK]",), ("!",)], "token string")
    assert in_order(subword.wordpiece(corpus(spark, "unable xyz!"), pieces)) == [["un", "##able", "[UNK]", "!"]]
    ids = spark.createDataFrame([("a", 4), ("b", 7)], "token string, id bigint")
    assert in_order(tokenizers.encode_ids(token_frame(spark, "a c b"), ids, unknown=1), "ids") == [[4, 1, 7]]


def test_bert_vocab(spark):
    rows = ["<unk>", "<s>", "</s>", "▁", "▁ab", "cd", "▁a▁b"]
    pieces = spark.createDataFrame(list(enumerate(rows)), "id bigint, piece string")
    made = [r.token for r in subword.to_bert_vocab(pieces).orderBy("id").collect()]
    assert made == ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", "ab", "##cd", "ab"]


def test_cooccurrence(spark):
    df = token_frame(spark, "a b c", "a z b", *["a " * 1 + "b"] * 0)
    words = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id bigint, word string")
    cells = {(r.w1, r.w2): r.x for r in cooccur.cooccurrence(df, words, 2).collect()}
    assert cells == {("a", "b"): 2.0, ("b", "a"): 2.0, ("a", "c"): 0.5, ("c", "a"): 0.5, ("b", "c"): 1.0, ("c", "b"): 1.0}


def test_pmi_leaves_cells_in_place(spark):
    """Marginals within the limit are broadcast, larger ones are merged, with the same result."""
    cells = cooccur.cooccurrence(token_frame(spark, "a b a c", "b a"), spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id bigint, word string"), 2)
    found = lambda: cooccur.pmi(cells)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        here = found()
        assert "SortMergeJoin" not in plan(here)
        spark.conf.set(BROADCAST_CONF, "0")
        there = found()
        assert "SortMergeJoin" in plan(there)
        assert sorted(map(str, here.collect())) == sorted(map(str, there.collect()))
    finally:
        spark.conf.unset(BROADCAST_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cooccurrence_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(cooccur, "BLOCK", 64)
    n = 3 * cooccur.BLOCK + 7
    names = [f"w{i % 11}" for i in range(n)]
    words = spark.createDataFrame([(i, f"w{i}") for i in range(11)], "id bigint, word string")
    got = {(r.i, r.j): r.x for r in cooccur.cooccurrence_ids(token_frame(spark, " ".join(names)), words, 4).collect()}
    want = Counter()
    for i in range(n):
        for d in range(1, 5):
            if i + d < n:
                want[i % 11, (i + d) % 11] += 1 / d
                want[(i + d) % 11, i % 11] += 1 / d
    assert got == pytest.approx(dict(want))


def test_spacing(spark):
    train = corpus(spark, *["the cat sat"] * 12)
    model = spacing.spacing_train(train)
    fixed = spacing.spacing_apply(corpus(spark, "thecat sat", "", "the catsat"), model)
    assert [r.line for r in fixed.orderBy("line_no").collect()] == ["the cat sat", "the cat sat"]


ARRAY_QUERIES = ["t02_lexicon_tokens", "t04_l_tokens", "t05_wordpiece", "t07_encode_ids", "a12_spacing_apply", "v02_weighted_vectors"]


@pytest.mark.parametrize("name", ARRAY_QUERIES)
def test_joined_lookup_equals_in_task(spark, data, name, request):
    fast = sorted(map(str, catalog.QUERIES[name](spark, data).collect()))
    request.getfixturevalue("joins_only")
    assert sorted(map(str, catalog.QUERIES[name](spark, data).collect())) == fast


@pytest.mark.parametrize("limit", ["0", "200", "380", "500"])
def test_lookup_beyond_the_limit_by_frequency(spark, limit):
    """Frequent elements in the task, the others joined; keys may repeat or be NULL."""
    words = [["a", "a", "b", None, "z"], ["a", "c", "b"], [], None, ["z", "d", "a"], ["a", "a"]]
    df = spark.createDataFrame([(None if i == 1 else i % 2, w) for i, w in enumerate(words)], "doc_id int, tokens array<string>")
    table = spark.createDataFrame([("a", [1, 2]), ("b", [3]), ("c", []), ("d", None), ("e", [5])], "word string, x array<int>")
    found = lambda: sorted(str((r.doc_id, r.tokens, r.v)) for r in lookup(df, "tokens", table, "word", "x", "v", ["doc_id"]).collect())
    expected = found()
    assert str((0, ["z", "d", "a"], [None, None, [1, 2]])) in expected
    spark.conf.set(BROADCAST_CONF, limit)
    try:
        assert found() == expected
    finally:
        spark.conf.unset(BROADCAST_CONF)


@pytest.mark.parametrize("name", ["s13_shards", "a02_lm_vocab", "t04_l_tokens", "p03_sentence_pairs", "a15_pmi"])
def test_partition_count_does_not_matter(spark, data, name):
    results = []
    for n in ("1", "4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(str, catalog.QUERIES[name](spark, data).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


# ---------------------------------------------------------------- least-cost morphs


def every_path(token, words, unknown):
    """All chains of lexicon and unknown words, with their costs by themselves."""
    classes = [lattice.char_class(c) for c in token]

    def paths(at):
        if at == len(token):
            yield [], 0
            return
        run = at + 1
        while run < len(token) and classes[run] == classes[at]:
            run += 1
        rule = unknown[classes[at]]
        options = [(end, tag, cost) for end in range(at + 1, len(token) + 1) for tag, cost in words.get(token[at:end], [])]
        options += [(end, rule.tag, rule.cost + rule.per_character * (end - at)) for end in {at + 1, run}]
        for end, tag, cost in options:
            for rest, total in paths(end):
                yield [(token[at:end], tag), *rest], cost + total

    yield from paths(0)


def test_cheapest_paths_by_enumeration():
    rnd = random.Random(3)
    for _ in range(300):
        words = {"".join(rnd.choice("ab1가") for _ in range(rnd.randint(1, 3))): [(t, rnd.randint(1, 9) * 100) for t in rnd.sample("NJV", rnd.randint(1, 2))] for _ in range(8)}
        tags = ["", "N", "J", "V", "UNK", "SL", "SN"]
        costs = {(a, b): rnd.randint(0, 9) * 50 for a in tags for b in tags if rnd.random() < 0.8}
        token = "".join(rnd.choice("ab1가!") for _ in range(rnd.randint(1, 6)))
        found = lattice.cheapest_path(token, lattice.edges_of(token, words, 3, lattice.UNKNOWN), costs)

        def cost(path, own):
            chain = ["", *[t for _, t in path], ""]
            return own + sum(costs.get(pair, lattice.UNSEEN) for pair in zip(chain, chain[1:]))

        every = [(cost(path, own), path) for path, own in every_path(token, words, lattice.UNKNOWN)]
        least = min(c for c, _ in every)
        assert "".join(m for m, _ in found) == token and found in [path for c, path in every if c == least]
    assert lattice.cheapest_path("", [[]], {}) == []


def test_lattice_tokens(spark, request):
    """Connections decide: after a noun the particle, at the end of a verb the ending; unknown runs stay whole."""
    words = spark.createDataFrame(
        [("나", "NP", 300), ("나", "VV", 400), ("는", "JX", 200), ("는", "ETM", 200), ("학교", "NNG", 500), ("에", "JKB", 100), ("날", "VV", 400)], "word string, tag string, cost int"
    )
    tags = [("", "NP", 50), ("NP", "JX", 50), ("JX", "", 10), ("", "VV", 200), ("VV", "ETM", 60), ("ETM", "", 400), ("", "NNG", 60), ("NNG", "JKB", 30), ("JKB", "", 10), ("SL", "", 100), ("", "SL", 100), ("SL", "JX", 100)]
    pairs = spark.createDataFrame(tags, "before string, after string, cost int")
    lines = token_frame(spark, "나는 학교에 iPhone는 는", "", "나는")
    want = [
        [("나", "NP"), ("는", "JX"), ("학교", "NNG"), ("에", "JKB"), ("iPhone", "SL"), ("는", "JX"), ("는", "JX")],
        [],
        [("나", "NP"), ("는", "JX")],
    ]
    for _ in range(2):
        got = in_order(lattice.lattice_tokenize(lines.withColumn("tokens", F.filter("tokens", lambda t: t != "")), words, pairs), "tagged")
        assert [[tuple(p) for p in line] for line in got] == want
        request.getfixturevalue("joins_only")


def test_only_likely_substrings_meet_a_large_lexicon(spark):
    """No entry of the lexicon is lost; of other substrings few pass."""
    rnd = random.Random(5)
    entries = {"".join(rnd.choice("abcdé가🙂") for _ in range(rnd.randint(1, 6))) for _ in range(300)}
    tokens = ["".join(rnd.choice("abcdé가🙂") for _ in range(30)) for _ in range(60)]
    by_word = spark.createDataFrame([(w,) for w in sorted(entries)], "word string")
    df = spark.createDataFrame([(t,) for t in [*tokens, ""]], "token string")
    got = {r.token: r.found for r in df.select("token", lattice._likely_words(by_word, 6)("token").alias("found")).collect()}
    every = {t: {t[i:j] for i in range(30) for j in range(i + 1, min(30, i + 6) + 1)} for t in tokens}
    assert got[""] == [] and all(len(got[t]) == len(set(got[t])) for t in tokens)
    assert all(every[t] & entries <= set(got[t]) <= every[t] for t in tokens)
    assert sum(len(set(got[t]) - entries) for t in tokens) < 0.1 * sum(map(len, every.values()))


def test_costs_count_distinct_tokens(spark, monkeypatch):
    """What is stored of a tagged corpus grows with its distinct tokens."""
    sizes = []
    monkeypatch.setattr(lattice, "cut_lineage", lambda df: sizes.append(df.count()) or df)
    tagged = spark.range(500).select(F.array(F.struct(F.lit("a").alias("morph"), F.lit("N").alias("tag"))).alias("pieces"))
    words, pairs = lattice.estimate_costs(tagged)
    assert [tuple(r) for r in words.collect()] == [("a", "N", 0)] and pairs.count() == 2 and max(sizes) <= 2


def test_costs_from_tagged_tokens(spark):
    rows = [([("a", "N"), ("s", "J")],), ([("a", "N")],), ([("b", "N"), ("s", "J")],), ([],)]
    tagged = spark.createDataFrame(rows, "pieces array<struct<morph: string, tag: string>>")
    words, pairs = lattice.estimate_costs(tagged)
    cost = lambda share: round(-100 * math.log(share))
    assert {(r.word, r.tag): r.cost for r in words.collect()} == {("a", "N"): cost(2 / 3), ("b", "N"): cost(1 / 3), ("s", "J"): 0}
    got = {(r.before, r.after): r.cost for r in pairs.collect()}
    assert got == {("", "N"): cost(4 / 6), ("N", "J"): cost(3 / 6), ("N", ""): cost(2 / 6), ("J", ""): cost(3 / 5)}


def test_lattice_query_keeps_every_character(spark, data):
    got = {(r.doc_id, r.line_no): r.tagged for r in catalog.t02_lattice(spark, data).collect()}
    for r in catalog.tokens(spark, data).collect():
        morphs = [m.rsplit("/", 1)[0] for m in got[r.doc_id, r.line_no].split(" ") if m]
        assert "".join(morphs) == "".join(r.tokens)


def test_packed_pairs_give_the_sums_of_all_pairs(spark):
    """Parts of few ids, wide ids, and a vocabulary of which only a part is broadcast."""
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 40, 300)
    for offset in (0, 1 << 30):  # beyond it ids and distance do not share a number
        want = Counter()
        for d in (1, 2, 3):
            for a, b in zip(ids[:-d] + offset, ids[d:] + offset):
                want[int(min(a, b)) << 32 | int(max(a, b))] += 6 // d
        got = Counter()
        for keys, sums in cooccur.pair_sums(ids + offset, np.zeros(300, int), [6, 3, 2]):
            assert (np.diff(keys) > 0).all()
            got.update(dict(zip(keys.tolist(), sums.tolist())))
            packs = [cooccur._unpacked(p, n, data, 7) for p, n, data in cooccur._packed(keys, sums, 7)]
            again = cooccur.summed_pairs(*(np.concatenate(c) for c in zip(*packs)))
            assert len(packs) == 7 and all((x == y).all() for x, y in zip(again, (keys, sums)))
        assert got == want
    lines = [" ".join(f"w{i}" for i in rng.integers(0, 40, 25)) for _ in range(40)]
    words = spark.createDataFrame([(i, f"w{i}") for i in range(38)], "id bigint, word string")
    table = lambda: sorted(map(tuple, cooccur.cooccurrence(token_frame(spark, *lines).repartition(5), words, 3).collect()))
    expected = table()
    for limit in ("134217728", "1200", "0"):
        spark.conf.set(BROADCAST_CONF, limit)
        try:
            assert table() == expected
        finally:
            spark.conf.unset(BROADCAST_CONF)


def test_pairs_travel_packed(spark):
    """No row for each pair is shuffled, and marginals add integers."""
    words = spark.createDataFrame([(0, "a"), (1, "b")], "id bigint, word string")
    cells = cooccur.cooccurrence_ids(token_frame(spark, "a b a", "b a"), words, 2)
    plan = cooccur.cooc_marginals(cells, "i")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(part" in plan and "hashpartitioning(pair" not in plan
    xs = [1 / 3, 2.5e5 + 1 / 7, 0.1, 1e-11, 123456.00000000005] * 3
    rows = spark.createDataFrame([("k", x) for x in xs], "w1 string, x double")
    total = rows.selectExpr("cast(sum(cast(x as decimal(28,10))) as double) t").first().t
    assert cooccur.cooc_marginals(rows).first().total == pytest.approx(total, abs=1e-9)


def test_pmi_stores_no_second_copy_of_its_cells(spark, data, monkeypatch):
    kept, own = [], cooccur.stored
    monkeypatch.setattr(cooccur, "stored", lambda df: kept.append(df.columns) or own(df))
    catalog.a15_pmi(spark, data)
    assert kept == [["i", "j", "x"]]
    kept.clear()
    catalog.a15_marginals(spark, data)
    assert kept == []
