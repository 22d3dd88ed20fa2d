"""Sub-word vocabularies against plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lexloom.functions import text as tx
from lexloom.operators import pairmerge, subword, unigram, vocab
from lexloom.plans import catalog
from lexloom.session import BROADCAST_CONF


def corpus(spark, *lines):
    return spark.createDataFrame([(0, i, s) for i, s in enumerate(lines)], "doc_id bigint, line_no int, line string")


def in_order(df, col="tokens"):
    return [r[col] for r in df.orderBy("doc_id", "line_no").collect()]


def word_table(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word string, cnt bigint")


# ---------------------------------------------------------------- pair merging


def reference_merges(words, wanted):
    """One merge at a time, most frequent pair first, ties by the smaller pair."""
    split = {tuple("▁" + w): n for w, n in words.items()}
    made, known = [], {c for w in split for c in w}
    while len(made) < wanted:
        pairs = Counter()
        for w, n in split.items():
            for pair in zip(w, w[1:]):
                pairs[pair] += n
        if not pairs:
            break
        a, b = min(pairs, key=lambda p: (-pairs[p], p))
        if a + b not in known:
            made.append(a + b)
        known.add(a + b)
        after = {}
        for w, n in split.items():
            out, i = [], 0
            while i < len(w):
                if w[i : i + 2] == (a, b):
                    out.append(a + b)
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            after[tuple(out)] = after.get(tuple(out), 0) + n
        split = after
    return made


def trained(spark, text, wanted=100_000):
    """The merged pieces of a text, and the same by plain merging."""
    words = Counter(text.split())
    alphabet = {c for w in words for c in w} | {"▁"}
    pieces = [r.piece for r in pairmerge.bpe_train(corpus(spark, text), 3 + len(alphabet) + wanted, coverage=1.0).orderBy("id").collect()]
    want = reference_merges(words, wanted)
    assert pieces[:3] == ["<unk>", "<s>", "</s>"] and set(pieces[3 + len(want) :]) == alphabet
    return pieces[3 : 3 + len(want)], want


def test_pair_merging_is_exact(spark):
    made, want = trained(spark, "aaaa aaab banana bandana low lower lowest newest wider wide new banana low abab ababab", 25)
    assert made == want and len(want) == 25


@pytest.mark.parametrize("hot, seed", [(1, 0), (2, 1), (3, 2), (7, 3), (40, 4)])
def test_rounds_do_not_change_merges(spark, monkeypatch, hot, seed):
    """Few hot pairs a round, many equal counts: the tie rounds take pairs of one count bit by bit."""
    monkeypatch.setattr(pairmerge, "HOT_PAIRS", hot)
    monkeypatch.setattr(pairmerge, "MOST_HOT_PAIRS", hot)
    rnd = random.Random(seed)
    text = " ".join("".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 6))) for _ in range(12))
    made, want = trained(spark, text)
    assert made == want


def test_tied_pairs_by_joins(spark, monkeypatch, joins_only):
    monkeypatch.setattr(pairmerge, "MOST_HOT_PAIRS", 4)
    monkeypatch.setattr(pairmerge, "HOT_PAIRS", 4)
    monkeypatch.setattr(pairmerge, "measured", lambda df, limit: (df, df.toArrow()))  # of segments alone
    made, want = trained(spark, "abcd bcda cdab dabc aabb", 12)
    assert made == want


def test_many_segments_mean_fewer_hot_pairs(spark, monkeypatch):
    monkeypatch.setattr(pairmerge, "SEGMENT_BYTES", 2500)
    rnd = random.Random(9)
    text = " ".join("".join(rnd.choice("aaabbcde") for _ in range(rnd.randint(2, 8))) for _ in range(60))
    made, want = trained(spark, text, 30)
    assert made == want


def test_merges_in_order_and_their_use():
    """3 000 random corpora rich in ties: choosing merges with an index, and applying them word by word."""
    rnd = random.Random(1)
    for _ in range(3000):
        words = {"".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 6))): rnd.randint(1, 3) for _ in range(rnd.randint(1, 8))}
        size = rnd.randint(1, 12)
        want = reference_merges(words, size)
        known = {c for w in words for c in "▁" + w}
        merges = pairmerge.merges_in_order([(list("▁" + w), n) for w, n in words.items()], size, known)
        made = dict.fromkeys(a + b for a, b in merges if a + b not in known)
        assert list(made) == want
        order = defaultdict(list)
        for i, pair in enumerate(merges):
            order[pair].append(i)
        for w in words:
            symbols = list("▁" + w)
            for pair in merges:
                symbols = pairmerge.merge_pair(symbols, pair)
            assert pairmerge.apply_merges(list("▁" + w), order) == symbols


def test_a_piece_made_in_two_ways_is_merged_twice():
    merges = [("x", "y"), ("xy", "z"), ("xyz", "w"), ("y", "z"), ("x", "yz"), ("xyz", "w")]
    order = defaultdict(list)
    for i, pair in enumerate(merges):
        order[pair].append(i)
    assert pairmerge.apply_merges(["x", "yz", "w"], order) == ["xyzw"]
    assert pairmerge.apply_merges(["x", "yz", "w"], {k: v[:1] for k, v in order.items()}) == ["xyz", "w"]


def test_pair_merging_query_at_full_size(spark):
    """The registered query over the whole documents against one-at-a-time merging of all words in one process."""
    folder = "/root/testdata/sf0.01"
    pieces = [r.piece for r in catalog.a04_bpe_train(spark, folder).orderBy("id").collect()]
    lines = catalog.lines(spark, folder)
    counts = {r.word: r.cnt for r in vocab.token_counts(lines.select(tx.split_tokens(tx.strip_line("line")).alias("t")), "t").collect()}
    n = Counter()
    for w, c in counts.items():
        for ch in "▁" + w:
            n[ch] += c
    chars, before, total = [], 0, sum(n.values())
    for ch in sorted(n, key=lambda ch: (-n[ch], ch)):
        if before < total * 0.9995:
            chars.append(ch)
        before += n[ch]
    parts = Counter()
    for w, c in counts.items():
        part = ""
        for ch in "▁" + w + "\n":
            if ch in chars:
                part += ch
            else:
                parts[part] += c
                part = ""
    del parts[""]
    known = set(chars)
    merges = pairmerge.merges_in_order(((list(w), c) for w, c in parts.items()), 32_000 - 3 - len(chars), known)
    want = list(dict.fromkeys(a + b for a, b in merges if a + b not in known))
    assert len(pieces) == 32_000 and pieces == ["<unk>", "<s>", "</s>", *want, *chars]


def test_chain_from_training_to_tokens(spark, data):
    """Pieces trained on the documents, made a matching vocabulary, cut the same documents."""
    got = {(r.doc_id, r.line_no): r.tokens for r in catalog.t05_trained_wordpiece(spark, data).collect()}
    lines = catalog.lines(spark, data)
    pieces = pairmerge.bpe_train(lines).orderBy("id").collect()
    tokens = {"[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"}
    for r in pieces:
        if r.piece not in ("<unk>", "<s>", "</s>", "▁", ""):
            tokens.add(r.piece.replace("▁", "") if r.piece.startswith("▁") else "##" + r.piece)
    longest = max(map(len, tokens))
    for r in lines.withColumn("words", tx.split_punctuation(tx.strip_line("line"))).collect():
        want = [p for w in r.words for p in subword.greedy_pieces(w, tokens, longest)]
        assert got[r.doc_id, r.line_no] == " ".join(want)


# ---------------------------------------------------------------- unigram pieces


def reference_repeats(words):
    """{substring: occurrences} of what neither side extends without losing an occurrence."""
    total, left, right = Counter(), defaultdict(Counter), defaultdict(Counter)
    for k, (w, n) in enumerate(words.items()):
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                total[w[i:j]] += n
                left[w[i:j]][w[i - 1] if i else ("start", k)] += n
                right[w[i:j]][w[j] if j < len(w) else ("end", k)] += n
    own = lambda side, n: max((c for x, c in side.items() if isinstance(x, str)), default=0) < n
    return {s: n for s, n in total.items() if n > 1 and own(left[s], n) and own(right[s], n)}


@pytest.mark.parametrize("chunk, parts", [(64, 1), (64, 7), (1, 5), (2, 3), (3, 16)])
def test_repeated_substrings(spark, chunk, parts):
    rnd = random.Random(chunk)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 14))): rnd.randint(1, 3) for _ in range(40)}
    words |= {"x" + "abc" * 30: 1, "y" + "abc" * 25 + "z": 2, "🙂é" * 4: 1, "q" * 20: 1}
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = unigram.repeated_substrings(word_table(spark, words), chunk).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == len({r.piece for r in found})
    assert {r.piece: r.n for r in found} == reference_repeats(words)


def test_repeats_longer_than_any_piece_before(spark):
    long = "".join(random.Random(2).choice("abcdefgh") for _ in range(3000))
    found = unigram.repeated_substrings(word_table(spark, {long: 2, "x" + long: 1})).collect()
    assert (long, 3) in {(r.piece, r.n) for r in found}
    assert unigram.repeated_substrings(word_table(spark, {long: 2}).filter("cnt > 2")).count() == 0


def all_ways(word, scores, unknown):
    if not word:
        yield [], 0.0
    for n in range(1, len(word) + 1):
        score = scores.get(word[:n], unknown if n == 1 else None)
        if score is not None:
            for rest, total in all_ways(word[n:], scores, unknown):
                yield [word[:n], *rest], score + total


SCORES = {"a": -1.0, "b": -1.5, "ab": -2.0, "aba": -2.4, "ba": -2.0, "▁a": -1.7}


def test_batched_recursions_equal_enumeration():
    words = [("abab", 3), ("aabb", 1), ("babab", 2), ("▁aba", 5), ("abca", 1), ("a", 2), ("bb", 1)]
    seen = 0
    for group, lattice in unigram.lattices(words, lambda row: SCORES, 3, -9.0):
        shares = lattice.shares()
        best = [[] for _ in group]
        for edges in lattice.best_edges():
            for e in edges:
                best[lattice.row[e]].append(group[lattice.row[e]][0][lattice.start[e] : lattice.end[e]])
        for row, (word, _) in enumerate(group):
            ways = list(all_ways(word, SCORES, -9.0))
            norm = sum(math.exp(s) for _, s in ways)
            want = Counter()
            for way, s in ways:
                at = 0
                for piece in way:
                    want[at, at + len(piece)] += math.exp(s) / norm
                    at += len(piece)
            got = {(int(lattice.start[e]), int(lattice.end[e])): shares[e] for e in range(len(shares)) if lattice.row[e] == row}
            assert got == pytest.approx(dict(want))
            made = best[row][::-1]
            assert made == unigram.best_segmentation(word, SCORES, 3, -9.0)
            assert sum(SCORES.get(p, -9.0) for p in made) == pytest.approx(max(s for _, s in ways))
            seen += 1
    assert seen == len(words)


def reference_counts(words, scores, kind):
    unknown, found = min(scores.values()) - 10, Counter()
    for w, n in words.items():
        ways = list(all_ways(w, scores, unknown))
        if kind == "best":
            # equal ones prefer the longer last piece, then the longer one before it
            top = max(s for _, s in ways)
            way = max((way for way, s in ways if abs(s - top) < 1e-12), key=lambda way: [len(p) for p in way[::-1]])
            for p in way:
                found[p] += n
        else:
            norm = sum(math.exp(s) for _, s in ways)
            share = Counter()
            for way, s in ways:
                at = 0
                for p in way:
                    share[at, p] += math.exp(s) / norm
                    at += len(p)
            for (_, p), x in share.items():
                found[p] += round(x * 1_000_000) * n
    return Counter({p: n for p, n in found.items() if p in scores})


def reference_losses(words, scores):
    uses = reference_counts(words, scores, "best")
    total = sum(uses.values())
    losses = {}
    for p in scores:
        if len(p) > 1:
            others = {q: s for q, s in scores.items() if q != p}
            n = uses[p]
            parts = unigram.best_segmentation(p, others, 99, min(scores.values()) - 10)
            later = math.log(total + n * (len(parts) - 1))
            losses[p] = n / total * (math.log(n) - math.log(total) - sum(math.log(uses[q] + n) - later for q in parts)) if n else -math.inf
    return losses


@pytest.mark.parametrize("way", ["in task", "joined"])
def test_losses_of_removal(spark, request, way):
    if way == "joined":
        request.getfixturevalue("joins_only")
    rnd = random.Random(8)
    words = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 7))): rnd.randint(1, 9) for _ in range(60)}
    scores = {"a": -1.2, "b": -1.31, "c": -1.43, "ab": -2.17, "bc": -2.6, "abc": -2.93, "ca": -3.11, "bca": -4.77, "aa": -2.41}
    table = spark.createDataFrame(list(scores.items()), "piece string, score double")
    got = {r.piece: r.loss for r in unigram.removal_losses(word_table(spark, words), table).collect()}
    assert got == pytest.approx(reference_losses(words, scores))
    assert got["bca"] == -math.inf and max(got.values()) > -math.inf


def trained_pieces(words, wanted, keep=0.75):
    """{piece: count} by the same rule in one process."""
    chars = Counter()
    for w, n in words.items():
        chars.update({c: w.count(c) * n for c in set(w)})
    counts = Counter(reference_repeats(words)) | chars
    while True:
        for _ in range(2):
            total = math.log(sum(counts.values()))
            found = reference_counts(words, {p: math.log(n) - total for p, n in counts.items()}, "expected")
            counts = {p: (found[p] if found[p] >= 500_000 else 1) for p in counts if found[p] >= 500_000 or p in chars}
        if len(counts) <= wanted:
            return counts
        room = max(wanted, int(len(counts) * keep)) - len(chars)
        total = math.log(sum(counts.values()))
        losses = reference_losses(words, {p: math.log(n) - total for p, n in counts.items()})
        best = sorted(losses, key=lambda p: (-losses[p], p))[:room]
        counts = {p: counts[p] for p in [*best, *chars]}


@pytest.mark.parametrize("size, way", [(45, "in task"), (45, "joined"), (32000, "in task")])
def test_unigram_equals_plain_training(spark, request, size, way):
    if way == "joined":
        request.getfixturevalue("joins_only")
    rnd = random.Random(3)
    some = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    text = " ".join(rnd.choice(some) for _ in range(300))
    made = unigram.unigram_train(corpus(spark, text), size, coverage=1.0).filter("kind = 'piece'").orderBy("id").collect()
    others = 3 + len(unigram.CONTROL_SYMBOLS) + len(unigram.USER_SYMBOLS)
    want = trained_pieces(Counter("▁" + w for w in text.split()), size - others)
    total = math.log(sum(want.values()))
    assert {r.piece: r.score for r in made} == pytest.approx({p: math.log(n) - total for p, n in want.items()}, abs=1e-3)
    assert [r.id for r in made] == list(range(others, others + len(made)))


def test_unigram(spark):
    lines = corpus(spark, *["banana bandana ban (banana)"] * 20)
    pieces = unigram.unigram_train(lines, vocab_size=34, coverage=1.0)
    table = pieces.orderBy("id").collect()
    assert len(table) <= 34 and [r.piece for r in table[:4]] == ["<unk>", "<s>", "</s>", "<cls>"]
    coded = in_order(unigram.unigram_encode(corpus(spark, "banana (x) ban"), pieces))[0]
    assert "".join(coded) == "▁banana▁(x)▁ban" and "(" in coded


def test_unigram_joined_equals_in_task(spark, request):
    lines = corpus(spark, "banana bandana", "ban x")
    pieces = unigram.unigram_train(corpus(spark, *["banana bandana ban"] * 9), vocab_size=30, coverage=1.0).cache()
    fast = in_order(unigram.unigram_encode(lines, pieces))
    request.getfixturevalue("joins_only")
    assert in_order(unigram.unigram_encode(lines, pieces)) == fast


def test_unigram_query_keeps_more_than_a_thousand_pieces(spark, data):
    assert catalog.a05_unigram_train(spark, data).count() > 1000


def test_nothing_to_train_on(spark):
    empty = corpus(spark, "x").filter("1 = 0")
    assert [r.piece for r in pairmerge.bpe_train(empty).orderBy("id").collect()] == ["<unk>", "<s>", "</s>"]
    assert unigram.unigram_train(empty).filter("kind = 'piece'").count() == 0


def test_unigram_steps_join_no_substrings(spark, monkeypatch):
    """A table of pieces beyond the limit, whose scores by number are within it, meets the words once, by blocks."""
    rnd = random.Random(3)
    some = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    text = " ".join(rnd.choice(some) for _ in range(300))
    others = 3 + len(unigram.CONTROL_SYMBOLS) + len(unigram.USER_SYMBOLS)
    joins, word_scores = [], unigram.word_scores
    monkeypatch.setattr(unigram, "word_scores", lambda *given: joins.append(1) or word_scores(*given))
    spark.conf.set(BROADCAST_CONF, "4096")
    try:
        made = unigram.unigram_train(corpus(spark, text), 45, coverage=1.0).filter("kind = 'piece'").collect()
    finally:
        spark.conf.unset(BROADCAST_CONF)
    want = trained_pieces(Counter("▁" + w for w in text.split()), 45 - others)
    total = math.log(sum(want.values()))
    assert {r.piece: r.score for r in made} == pytest.approx({p: math.log(n) - total for p, n in want.items()}, abs=1e-3)
    assert not joins


def test_sums_by_number_are_exact_beyond_64_bits():
    sums, told = unigram._NumberSums(3), Counter()
    given = [([0, 1, -1], [999_999, 1_000_000, 5], [1 << 50, 3, 7]), ([1, 1], [7, 11], [1 << 44, 1 << 43]), ([2], [1], [1])]
    batches = [b for ids, parts, times in given for b in sums.add(*(np.array(x, np.int64) for x in (ids, parts)), 1_000_001, np.array(times, np.int64))]
    for batch in [*batches, sums.batch()]:
        for row in batch.to_pylist():
            told[row["id"]] += row["n"]
    assert told == {0: 999_999 << 50, 1: 3_000_000 + (7 << 44) + (11 << 43), 2: 1}
