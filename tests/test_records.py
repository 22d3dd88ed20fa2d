from pyspark.sql import functions as F

from lexloom.operators import pretrain


def framed(spark, docs=8):
    rows = [(d, "\n".join(f"s{d}x{i} " + " ".join(["w"] * (i % 5)) for i in range(30 + d * 20))) for d in range(docs)]
    return pretrain.frame_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_segments_keep_whole_documents(spark):
    base = framed(spark)
    total = {r.doc_id: r.n for r in base.select("doc_id", F.size("tokens").alias("n")).collect()}
    sentences = pretrain.sentence_segments(base).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.doc_id: r.n for r in sentences} == total
    packed = sorted(pretrain.pack_segments(base).collect(), key=lambda r: (r.doc_id, r.seg))
    assert all(len(r.tokens) <= 125 and r.ends[-1] == len(r.tokens) for r in packed)
    for doc in base.collect():
        assert [t for r in packed if r.doc_id == doc.doc_id for t in r.tokens] == doc.tokens


def test_long_sentence_goes_on_in_the_next_segment(spark):
    base = pretrain.frame_documents(spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(300)))], "doc_id bigint, text string"))
    assert [(r.seg, len(r.tokens), r.ends) for r in pretrain.pack_segments(base).orderBy("seg").collect()] == [
        (0, 125, [125]), (1, 125, [125]), (2, 50, [50]),
    ]
    assert [(r.seg, r.n_tokens) for r in pretrain.sentence_segments(base).orderBy("seg").collect()] == [(0, 125), (1, 125), (2, 50)]


def test_pairs_use_every_token_once(spark):
    base = framed(spark)
    tokens = {r.doc_id: r.tokens for r in base.collect()}
    pairs = sorted(pretrain.nsp_pairs(base).collect(), key=lambda r: (r.doc_id, r.seg))
    for doc, expected in tokens.items():
        own = [r for r in pairs if r.doc_id == doc]
        assert [t for r in own for t in r.a + ([] if r.is_random_next else r.b)] == expected
        assert [r.seg for r in own] == list(range(len(own)))
    for r in pairs:
        assert 0 < len(r.a) and len(r.a) + len(r.b) <= 125
        if r.is_random_next:
            assert not any(t.startswith(f"s{r.doc_id}x") for t in r.b)
    assert 0.3 < sum(r.is_random_next for r in pairs) / len(pairs) < 0.7


def test_single_document_has_no_random_partner(spark):
    pairs = pretrain.nsp_pairs(framed(spark, 1)).collect()
    assert pairs and not any(r.is_random_next for r in pairs)


def test_masks(spark):
    records = pretrain.duplicate(pretrain.with_markers(pretrain.nsp_pairs(framed(spark))), 5)
    words = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id bigint, token string")
    before = {(r.doc_id, r.seg, r.copy): r for r in records.collect()}
    made = pretrain.mlm_masks(records, vocab=words)
    shown = {"mask": 0, "same": 0, "word": 0}
    for r in made.collect():
        old = before[r.doc_id, r.seg, r.copy]
        n = len(old.tokens)
        assert len(r.segment_ids) == n == len(r.tokens)
        assert len(r.masked_positions) == min(20, max(1, int(n * 0.15 + 0.5)))
        assert r.masked_labels == [old.tokens[i] for i in r.masked_positions]
        assert not set(r.masked_labels) & {"[CLS]", "[SEP]"}
        for i, t in enumerate(old.tokens):
            if i not in r.masked_positions:
                assert r.tokens[i] == t
            else:
                kind = "mask" if r.tokens[i] == "[MASK]" else "same" if r.tokens[i] == t else "word"
                shown[kind] += 1
                assert kind != "word" or r.tokens[i].startswith("v")
    total = sum(shown.values())
    assert 0.75 < shown["mask"] / total < 0.85 and shown["word"] > 0
    copies = made.groupBy("doc_id", "seg").agg(F.countDistinct(F.col("masked_positions").cast("string")).alias("n"))
    assert copies.agg(F.min("n")).first()[0] > 1


def test_mask_count_rounds_half_up_and_ignores_partitions(spark):
    df = spark.createDataFrame([(i, 0, 1, list("abcdefghij")) for i in range(20)], "doc_id bigint, seg int, copy int, tokens array<string>")
    a = {r.doc_id: r.masked_positions for r in pretrain.mlm_masks(df).collect()}
    b = {r.doc_id: r.masked_positions for r in pretrain.mlm_masks(df.repartition(7)).collect()}
    assert a == b and all(len(v) == 2 for v in a.values())


def test_windows_and_spans(spark):
    base = framed(spark, 2)
    tokens = {r.doc_id: r.tokens for r in base.collect()}
    windows = pretrain.xlnet_windows(base, seq_len=64, reuse_len=32, passes=2)
    for r in windows.collect():
        source = tokens[r.doc_id] if r.direction == "forward" else tokens[r.doc_id][::-1]
        assert r.tokens == source[r.win * 32 : r.win * 32 + 64]
    for r in pretrain.span_masks(windows).collect():
        assert len(r.masked_positions) <= 45 and len(set(r.masked_positions)) == len(r.masked_positions)
        assert all(0 <= p < len(r.tokens) for p in r.masked_positions)


def test_reframe_keeps_sentences(spark):
    df = spark.createDataFrame(
        [(1, ["ab", "c"], [0, 1], [["a", "##b"], ["c"]])],
        "doc_id bigint, tokens array<string>, sents array<bigint>, pieces array<array<string>>",
    )
    row = pretrain.reframe(df).first()
    assert row.tokens == ["a", "##b", "c"] and row.sents == [0, 0, 1]


def test_hashes_of_elements_begin_with_their_rows_keys_once(spark):
    """The same numbers as from all parts at once, NULL keys too, and digits that sort like them."""
    from lexloom.functions.arrays import once
    from lexloom.functions.hashing import continued, hash32, joined, number, rank_text

    rows = spark.createDataFrame([(1, "a", [5, 9, 0]), (None, "b", [3]), (None, None, []), (2, "c", None)], "k bigint, t string, at array<int>")
    keys = (7, "pick", F.col("k"), F.col("t"))
    whole = F.transform("at", lambda i: hash32(*keys, i))
    start = joined(*keys)
    parts = once(start, lambda p: F.transform("at", lambda i: number(continued(p, i))))
    ranked = once(start, lambda p: F.transform("at", lambda i: F.conv(rank_text(continued(p, i)), 16, 10).cast("bigint")))
    for r in rows.select(whole.alias("whole"), parts.alias("parts"), ranked.alias("ranked")).collect():
        assert r.whole == r.parts == r.ranked


def test_random_words_beyond_the_limit_are_joined_without_counting(spark, monkeypatch):
    """Records are worked out once; the masks are those of a small vocabulary."""
    from lexloom.operators import lookup

    rows = [(d, 0, c, ["[CLS]", *[f"t{d}_{i}" for i in range(40)], "[SEP]", None]) for d in range(6) for c in (1, 2)] + [(None, 0, 1, []), (7, 0, 1, None)]
    records = spark.createDataFrame(rows, "doc_id bigint, seg bigint, copy int, tokens array<string>")
    words = spark.createDataFrame([(i, f"w{i}") for i in range(50)], "id bigint, token string")
    made = lambda: sorted(map(str, pretrain.mlm_masks(records, rate=0.5, vocab=words).collect()))
    expected = made()
    assert any("='w" in r or "'w" in r for r in expected)

    def counted(*args):
        raise AssertionError("elements are counted")

    monkeypatch.setattr(lookup, "heaviest", counted)
    spark.conf.set("spark.lexloom.broadcastBytes", "700")
    try:
        assert made() == expected
    finally:
        spark.conf.unset("spark.lexloom.broadcastBytes")
