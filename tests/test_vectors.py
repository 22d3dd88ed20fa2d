import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.functions.vectors import random_vector
from lexloom.operators import cooccur, embed, factorize, grid, sentvec, skipgram, swivel, topics
from lexloom.plans import catalog
from lexloom.session import BROADCAST_CONF


def vectors(spark):
    return spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "word string, vec array<float>")


def test_sentence_means(spark, request):
    df = spark.createDataFrame([(0, ["a", "b", "z"]), (1, ["a", "a", "b", "b"]), (2, []), (3, ["z"])], "doc_id int, tokens array<string>")
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "word string, weight double")
    plain = {0: [0.5, 0.5], 1: [0.5, 0.5], 2: None, 3: None}
    heavy = {0: [0.25, 0.75], 1: [0.25, 0.75], 2: None, 3: None}
    for _ in range(2):
        got = {r.doc_id: r.vec for r in sentvec.sentence_vectors(df, vectors(spark)).collect()}
        assert got == plain
        got = {r.doc_id: r.vec for r in sentvec.sentence_vectors(df, vectors(spark), weights).collect()}
        assert got == heavy
        request.getfixturevalue("joins_only")


@pytest.mark.parametrize("limit", ["0", "400", "700"])
def test_sentence_means_beyond_the_limit(spark, monkeypatch, limit):
    """Frequent words in the task, others in blocks; keys may repeat or be NULL."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(12)]
    lines = [[words[int(k)] for k in rng.zipf(1.5, 20) % 14 if k % 14 < 12] + ["unknown"] for _ in range(30)]
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 4, t) for i, t in enumerate([*lines, [], None, ["unknown"]])], "doc_id int, tokens array<string>")
    vecs = spark.createDataFrame([(w, rng.normal(size=3).tolist()) for w in words], "word string, vec array<double>")
    weights = spark.createDataFrame([(w, float(i + 1)) for i, w in enumerate(words)], "word string, weight double")
    rows = lambda: sorted(((r.doc_id or -1, r.tokens or [], r.vec is not None), r.vec or []) for r in sentvec.sentence_vectors(df, vecs, weights).collect())
    expected = rows()
    monkeypatch.setattr(sentvec, "WORD_BLOCK_BYTES", 48)
    spark.conf.set(BROADCAST_CONF, limit)
    try:
        got = rows()
    finally:
        spark.conf.unset(BROADCAST_CONF)
    assert [k for k, _ in got] == [k for k, _ in expected]
    np.testing.assert_allclose(np.array([v for _, v in got if v]), np.array([v for _, v in expected if v]), rtol=1e-12)


def test_tag_and_subword_vectors(spark):
    df = spark.createDataFrame([("t", ["a", "a", "b"]), ("u", ["b"])], "tag string, tokens array<string>")
    tags = {r.tag: r.vec for r in embed.tag_vectors(df, vectors(spark), "tag").collect()}
    assert tags["u"] == [0.0, 1.0] and tags["t"] == pytest.approx([2 / 3, 1 / 3])
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "word string, cnt bigint")
    grams = embed.subword_vectors(vectors(spark), counts)
    assert {r.ngram: r.vec for r in grams.collect()} == {"<a>": [1.0, 0.0], "<b>": [0.0, 1.0]}
    unseen = spark.createDataFrame([("a",), ("q",)], "word string")
    assert [r.word for r in embed.compose_words(unseen, grams).collect()] == ["a"]


def random_cells(spark, n=40, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 3))
    full = base @ base.T
    cells = [(i, j, float(full[i, j]), 1.0) for i in range(n) for j in range(n) if rng.random() < 0.6 or i == j]
    keep = {(i, j) for i, j, _, _ in cells}
    return spark.createDataFrame([c for c in cells if (c[1], c[0]) in keep], "i bigint, j bigint, target double, weight double")


@pytest.mark.parametrize("limit", ["134217728", "0"])
def test_factor_error_falls(spark, limit):
    spark.conf.set(BROADCAST_CONF, limit)
    cells = factorize.sorted_cells(random_cells(spark))
    fit = factorize.als_factors(cells, 4, 4, ridge=1e-3)
    spark.conf.unset(BROADCAST_CONF)
    assert all(b <= a * (1 + 1e-9) for a, b in zip(fit.losses, fit.losses[1:])) and fit.losses[-1] < fit.losses[0] / 2
    table = cells.sorted.collect()
    rows, cols = ({r.id: np.array(r.vec) for r in side.collect()} for side in (fit.rows, fit.cols))
    gaps = [c.weight * (rows[c.i][:4] @ cols[c.j][:4] + rows[c.i][4] + cols[c.j][4] - c.target) ** 2 for c in table]
    squares = sum(v @ v for side in (rows, cols) for v in side.values())
    assert fit.error == pytest.approx(sum(gaps)) and fit.losses[-1] == pytest.approx(sum(gaps) + 1e-3 * squares)


class InOrder(factorize.Cells):
    """Cells cut into partitions as given."""

    def __init__(self, cells):
        self.sorted, self._grid = factorize.cut_lineage(cells.sortWithinPartitions("i", "j")), None


def solved(cells, monkeypatch=None, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(grid, name, value)
    return {r.id: r.vec for r in factorize.als_factors(cells, 3, 2).cols.collect()}


def test_every_layout_gives_the_same_factors(spark, monkeypatch, request):
    """Whole factors in tasks, with rows cut by partition bounds, and on grids with rows cut into slices."""
    raw = random_cells(spark)
    want = solved(InOrder(raw.coalesce(1)))
    found = [solved(InOrder(raw.repartitionByRange(23, "i", "j")))]
    request.getfixturevalue("joins_only")
    found.append(solved(factorize.sorted_cells(raw)))
    found.append(solved(factorize.sorted_cells(raw), monkeypatch, ROWS=7, COLS=5, PACK=11))
    found.append(solved(factorize.sorted_cells(raw), monkeypatch, ROWS=7, COLS=5, PACK=11, SLICE=40))
    for other in found:
        assert other.keys() == want.keys() and all(np.allclose(other[k], want[k]) for k in want)


def test_grid_sends_a_factor_block_once_for_each_pair_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(grid, "ROWS", 8)
    monkeypatch.setattr(grid, "COLS", 10)
    cells = random_cells(spark)
    made = grid.Grid(cells)
    assert made.pairs.count() == made.pairs.distinct().count() <= 5 * 4
    assert made.packs.agg(F.sum("n")).first()[0] == cells.count()


def plain_swivel(cells, rows, cols, marginal, total, ridge):
    """(new row factors, loss before) with a dense matrix."""
    ids = sorted(rows)
    w, c = (np.array([side[i] for i in ids]) for side in (rows, cols))
    m = np.array([marginal[i] for i in ids])
    at = {i: k for k, i in enumerate(ids)}
    target, weight = np.full((len(ids), len(ids)), np.nan), np.zeros((len(ids), len(ids)))
    for x in cells:
        target[at[x.i], at[x.j]], weight[at[x.i], at[x.j]] = x.pmi, 0.1 + 0.25 * x.x**0.5
    z = w @ c.T
    beyond = z - (np.log(total) - m[:, None] - m[None, :])
    seen = ~np.isnan(target)
    loss = np.where(seen, weight * (z - np.nan_to_num(target)) ** 2 / 2, np.log1p(np.exp(beyond))).sum()
    gains, wants = np.where(seen, weight, 0.25), np.where(seen, np.nan_to_num(target), z - 4 / (1 + np.exp(-beyond)))
    new = {}
    for k, i in enumerate(ids):
        new[i] = np.linalg.solve((c * gains[k][:, None]).T @ c + ridge * np.eye(c.shape[1]), (gains[k] * wants[k]) @ c)
    return new, loss


def pmi_fixture(spark, n=60, seed=4):
    """Two groups of words that occur among themselves only."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        for j in range(i, n):
            if i % 2 == j % 2 and rng.random() < 0.5:
                x = float(rng.integers(1, 30))
                rows += [(i, j, x), (j, i, x)] if i != j else [(i, j, x)]
    return cooccur.pmi(spark.createDataFrame(rows, "i bigint, j bigint, x double"))


def test_swivel_steps_equal_the_dense_form(spark, monkeypatch):
    for name, value in (("ROWS", 13), ("COLS", 17), ("PACK", 50)):
        monkeypatch.setattr(grid, name, value)
    cells = pmi_fixture(spark).collect()
    one = swivel.swivel_factors(pmi_fixture(spark), 5, 1)
    two = swivel.swivel_factors(pmi_fixture(spark), 5, 2)
    table = lambda df: {r.id: np.array(r.vec) for r in df.collect()}
    total = sum(x.x for x in cells)
    marginal = {}
    for x in cells:
        marginal[x.i] = marginal.get(x.i, 0) + x.x
    marginal = {i: np.log(v) for i, v in marginal.items()}
    rows, loss = plain_swivel(cells, table(one.rows), table(one.cols), marginal, total, 0.1)
    got = table(two.rows)
    assert all(np.allclose(got[i], rows[i]) for i in rows)
    squares = sum(v @ v for side in (table(one.rows), table(one.cols)) for v in side.values())
    assert two.losses[2] == pytest.approx(loss + 0.05 * squares)


def test_swivel_keeps_unobserved_pairs_below_observed_ones(spark):
    cells = pmi_fixture(spark).collect()
    fit = swivel.swivel_factors(pmi_fixture(spark), 8, 6)
    assert all(b <= a + 1e-9 for a, b in zip(fit.losses, fit.losses[1:])) and fit.losses[-1] < 0.7 * fit.losses[0]
    rows, cols = ({r.id: np.array(r.vec) for r in side.collect()} for side in (fit.rows, fit.cols))
    seen = {(x.i, x.j) for x in cells}
    inside = [rows[i] @ cols[j] for i in rows for j in rows if (i, j) in seen]
    across = [rows[i] @ cols[j] for i in rows for j in rows if i % 2 != j % 2]
    assert np.mean(inside) > np.mean(across) + 1 and np.quantile(inside, 0.1) > np.quantile(across, 0.9)
    words = spark.createDataFrame([(i, f"w{i}") for i in rows], "id bigint, word string")
    vectors = swivel.pmi_factorize(pmi_fixture(spark), words, 8, 2).collect()
    assert {r.word for r in vectors} == {f"w{i}" for i in rows} and {len(r.vec) for r in vectors} == {8}


def test_svd_matches_numpy(spark):
    rng = np.random.default_rng(5)
    dense = (rng.normal(size=(30, 4)) @ rng.normal(size=(4, 25))) * (rng.random((30, 25)) < 0.9)
    rows = [(i, j, float(dense[i, j])) for i in range(30) for j in range(25) if dense[i, j]]
    cells = spark.createDataFrame(rows, "i bigint, j bigint, x double")
    made, singular = factorize.svd_vectors(cells, 6, power=3)
    assert singular == pytest.approx(np.linalg.svd(dense, compute_uv=False)[:6], rel=1e-3)
    got = np.array([r.vec for r in made.orderBy("id").collect()])
    u, s, _ = np.linalg.svd(dense, full_matrices=False)
    want = u[:, :6] * s[:6]
    assert np.allclose(np.abs(got.T @ want) / (s[:6] ** 2)[:, None], np.eye(6), atol=0.05)


def test_passes_without_matrices_have_wide_row_blocks(spark, monkeypatch):
    """A factor is sent for as few row blocks as their sums allow, in every layout with the same result."""
    rng = np.random.default_rng(4)
    dense = np.where(rng.random((1500, 30)) < 0.2, rng.random((1500, 30)), 0.0)
    cells = spark.createDataFrame([(int(i), int(j), float(dense[i, j])) for i, j in zip(*dense.nonzero())], "i bigint, j bigint, x double")
    made, start = [], grid.Grid.__init__

    def watched(self, *args, **options):
        start(self, *args, **options)
        made.append(self.n_rows)

    monkeypatch.setattr(grid.Grid, "__init__", watched)
    spark.conf.set(BROADCAST_CONF, "0")
    try:
        _, first = factorize.svd_vectors(cells, 3)
        blocks = list(made)
        monkeypatch.setattr(grid, "WIDE_BYTES", 0)
        monkeypatch.setattr(grid, "WIDE_SLICE", 1000)
        _, second = factorize.svd_vectors(cells, 3)
    finally:
        spark.conf.unset(BROADCAST_CONF)
    assert blocks == [1, 1] and max(made[2:]) == 3
    np.testing.assert_allclose(first, second, rtol=1e-9)


def test_nearest_label_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sentvec, "TRAIN_BLOCK", 40)
    monkeypatch.setattr(sentvec, "TEST_BLOCK", 10)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5).tolist(), i % 3) for i in range(300)]
    rows += [(300 + i, rows[i][1], 2 - rows[i][2]) for i in range(20)]  # exact copies: ties
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    train, test = df.filter("vec_id % 7 <> 0"), df.filter("vec_id % 7 = 0")
    got = {r.vec_id: (r.nearest, r.predicted) for r in sentvec.nearest_label(train.repartition(5), test).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: y for i, _, y in rows}
    for q in [i for i, _, _ in rows if i % 7 == 0]:
        best = max((i for i in unit if i % 7), key=lambda i: (round(float(unit[q] @ unit[i]), 12), -i))
        assert got[q] == (best, str(label[best]))


def test_evaluate_and_probe(spark):
    pred = spark.createDataFrame([("m", "1", "1"), ("m", "0", "1"), ("n", "0", "0")], "model string, label string, predicted string")
    assert {r.model: r.accuracy for r in sentvec.evaluate(pred, by=["model"]).collect()} == {"m": 0.5, "n": 1.0}
    assert sentvec.confusion(pred).count() == 3
    rng = np.random.default_rng(2)
    rows = [((rng.normal(size=3) + (3 if y else -3)).tolist(), str(y)) for y in (0, 1) for _ in range(40)]
    data = spark.createDataFrame(rows, "vec array<double>, label string")
    scored, accuracy = sentvec.linear_probe(data, data)
    assert accuracy == 1.0 and scored.filter("label = predicted").count() == 80


def plain_topics(counts, theta, phi, iters, a=0.1, b=0.01):
    """EM over a dense (documents, words) matrix: objectives and the tables at the end."""
    losses = []
    for _ in range(iters):
        joint = theta[:, None, :] * phi[None, :, :]
        total = joint.sum(axis=2)
        losses.append(-(counts * np.log(total)).sum() - a * np.log(theta).sum() - b * np.log(phi).sum())
        shares = joint * (counts / total)[:, :, None]
        theta = shares.sum(axis=1) + a
        theta /= theta.sum(axis=1, keepdims=True)
        phi = shares.sum(axis=0) + b
        phi /= phi.sum(axis=0)
    return losses, theta, phi


@pytest.mark.parametrize("sizes", [{}, {"ROWS": 5, "COLS": 4, "PACK": 7, "SLICE": 20}])
def test_topics_equal_dense_em(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(grid, name, value)
    rng = np.random.default_rng(1)
    words = [f"{c}{i}" for c in "xy" for i in range(6)]
    rows = [(d, [words[6 * (d % 2) + rng.integers(6)] for _ in range(20)]) for d in range(14)] + [(14, []), (15, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")
    shares, named, losses, perplexity = topics.lda(df, 3, iters=4)
    counts = np.array([[(t or []).count(w) for w in words] for _, t in rows[:14]], float)
    start = spark.createDataFrame([(w,) for w in words], "word string").select("word", random_vector(F.col("word"), 3).alias("v")).collect()
    phi = np.array([r.v for r in start]) + 1
    want, theta, phi = plain_topics(counts, np.full((14, 3), 1 / 3), phi / phi.sum(axis=0), 4)
    assert losses == pytest.approx(want) and all(b <= a for a, b in zip(losses, losses[1:]))
    got = {r.doc_id: r.topics for r in shares.collect()}
    assert all(np.allclose(got[d], theta[d]) for d in range(14)) and got[14] == got[15] == pytest.approx([1 / 3] * 3)
    table = {r.word: r.vec for r in named.collect()}
    assert all(np.allclose(table[w], phi[k]) for k, w in enumerate(words)) and 1 < perplexity < 12


def test_probe_finds_the_least_objective(spark):
    rng = np.random.default_rng(4)
    rows = [((rng.normal(size=3) + [c, -c, 0.5 * c]).tolist(), "abc"[c]) for c in range(3) for _ in range(30)] + [(None, "a"), ([0.0, 0.0, 0.0], None)]
    df = spark.createDataFrame(rows, "vec array<double>, label string")
    probe = sentvec.fit_probe(df.repartition(5), ridge=0.01)
    assert probe.labels == ["a", "b", "c"] and all(b <= a for a, b in zip(probe.losses, probe.losses[1:]))
    x = np.array([[*v, 1.0] for v, y in rows if v and y])
    for c, name in enumerate(probe.labels):
        sign = np.array([1.0 if y == name else -1.0 for v, y in rows if v and y])
        slope = -((sign / (1 + np.exp(sign * (x @ probe.weights[c]))))[:, None] * x).mean(axis=0) + np.array([0.01, 0.01, 0.01, 0]) * probe.weights[c]
        assert np.abs(slope).max() < 1e-4
    scored = sentvec.apply_probe(df, probe)
    assert scored.filter("vec IS NULL").first().predicted is None
    assert sentvec.fit_probe(df.filter("1 = 0")).labels == []


def test_nearest_rows_by_lists(spark, monkeypatch):
    """Exact when every list is asked, also when lists span blocks; most rows are found in a few lists."""
    monkeypatch.setattr(sentvec, "TRAIN_BLOCK", 20)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + rng.normal(size=8) * 0.3).tolist(), i % 12) for i in range(900)]
    rows += [(900 + i, rows[i][1], 11 - rows[i][2]) for i in range(20)] + [(990, None, 1), (997, None, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    train, test = df.filter("vec_id % 7 <> 0"), df.filter("vec_id % 7 = 0")
    table = lambda f: {r.vec_id: (r.nearest, r.cosine, r.label, r.predicted) for r in f.collect()}
    exact = table(sentvec.nearest_label(train, test))
    assert table(sentvec.nearest_label_approx(train, test, lists=16, probes=16)) == exact
    few = table(sentvec.nearest_label_approx(train.repartition(7), test, lists=16, probes=4))
    assert sum(few[k][0] == exact[k][0] for k in exact) >= 0.9 * len(exact)
    assert sentvec.nearest_label_approx(train.filter("1 = 0"), test).count() == 0


def random_like(vectors, seed=99):
    """Other vectors for the same keys."""
    return vectors.withColumn("vec", F.transform(random_vector(F.col(vectors.columns[0]), catalog.DIM, seed), lambda v: v.cast("float")))


@pytest.mark.parametrize("name", ["m01_lsa_words", "m02_lsa_docs", "m04_word2vec"])
def test_queries_tell_random_vectors_from_trained_ones(spark, data, monkeypatch, name):
    assert [r.trained for r in catalog.QUERIES[name](spark, data).select("trained").distinct().collect()] == [True]
    own_words, own_docs, own_trained = embed.lsa_words, embed.lsa_docs, skipgram.Vectors.words
    monkeypatch.setattr(embed, "lsa_words", lambda *a, **k: random_like(own_words(*a, **k)))
    monkeypatch.setattr(embed, "lsa_docs", lambda *a, **k: random_like(own_docs(*a, **k)))
    monkeypatch.setattr(skipgram.Vectors, "words", lambda self: random_like(own_trained(self)))
    assert [r.trained for r in catalog.QUERIES[name](spark, data).select("trained").distinct().collect()] == [False]


@pytest.mark.parametrize("name", ["m05_glove", "m06_pmi_factors"])
def test_queries_tell_a_fit_that_learns_nothing(spark, data, monkeypatch, name):
    """One round of a fit whose every solution is replaced by a vector of noise."""
    assert [r.trained for r in catalog.QUERIES[name](spark, data).select("trained").distinct().collect()] == [True]
    noise = np.random.default_rng(0)
    monkeypatch.setattr(factorize, "_solve_side", lambda cells, others, dim, ridge: (others, 1e30))
    monkeypatch.setattr(swivel, "_half_round", lambda grid, rows, cols, *rest: (rows, 1.0 + noise.random()))
    assert [r.trained for r in catalog.QUERIES[name](spark, data).select("trained").distinct().collect()] == [False]


def test_nearest_rows_a_few_at_a_time(spark, monkeypatch):
    """A task compares some rows of a test block at once; the results are those of all pairs."""
    monkeypatch.setattr(sentvec, "ASKED", 3)
    rng = np.random.default_rng(3)
    known, asked = rng.normal(size=(40, 6)), rng.normal(size=(11, 6))
    frame = lambda rows, first: spark.createDataFrame([(first + k, [float(x) for x in v], k % 4) for k, v in enumerate(rows)], "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: (r.nearest, r.predicted) for r in sentvec.nearest_label(frame(known, 0), frame(asked, 100)).collect()}
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    best = (unit(asked) @ unit(known).T).argmax(axis=1)
    assert got == {100 + k: (int(b), str(b % 4)) for k, b in enumerate(best)}


def test_a_pass_sends_only_columns_with_cells(spark, monkeypatch):
    """Both directions of a product on one grid, of blocks and slices; a row block is sent no other column."""
    for name, value in (("ROWS", 4), ("COLS", 5), ("PACK", 6), ("WIDE_BYTES", 0), ("WIDE_SLICE", 9), ("PIECE", 2), ("CHUNK", 3)):
        monkeypatch.setattr(grid, name, value)
    rng = np.random.default_rng(8)
    dense = np.where(rng.random((15, 40)) < 0.15, rng.random((15, 40)), 0.0)
    rows = [(int(i), int(j), float(dense[i, j]), 1.0) for i, j in zip(*dense.nonzero())]
    made = grid.Grid(spark.createDataFrame(rows, "i bigint, j bigint, target double, weight double"), row_bytes=8)
    assert made.n_rows == 4 and made.n_cols == 8 and made.pairs.filter("slice > 0").count()
    side = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id bigint, vec array<double>")
    left, right = rng.random((40, 3)), rng.random((15, 3))
    for factors, of, want in ((left, made, dense @ left), (right, grid.Grid(None, of=made), dense.T @ right)):
        got = {r.id: r.vec for r in factorize._multiply(of, side(factors)).collect()}
        assert set(got) == set(np.flatnonzero(want.any(axis=1)).tolist())
        assert all(np.allclose(got[i], want[i]) for i in got)
    sent = sum(len(r.i) // 8 for r in grid._picked(made, side(left)).collect())
    assert sent == sum(len({j for i, j, *_ in rows if i % 4 == b}) for b in range(4)) < 4 * 40


def test_rare_words_meet_rows_in_blocks_by_frequency(spark, monkeypatch):
    """A row's rest lies in few blocks, a block that many rows ask for is cut, and only asked columns are stored."""
    rng = np.random.default_rng(6)
    words = [f"w{i:02}" for i in range(40)]
    lines = [[words[k] for k in rng.zipf(1.3, 30) if k < 40] for _ in range(60)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(lines)], "doc_id int, tokens array<string>, more string")
    vecs = spark.createDataFrame([(w, rng.normal(size=3).tolist() if i % 9 else None) for i, w in enumerate(words)], "word string, vec array<double>")
    rows = lambda: {r.doc_id: r for r in sentvec.sentence_vectors(df, vecs, keep=["doc_id"]).collect()}
    expected = rows()
    monkeypatch.setattr(sentvec, "WORD_BLOCK_BYTES", 4 * 24)
    monkeypatch.setattr(sentvec, "BLOCK_CELLS", 20)
    kept = []
    own = sentvec.stored
    monkeypatch.setattr(sentvec, "stored", lambda t: kept.append(own(t)) or kept[-1])
    spark.conf.set(BROADCAST_CONF, "700")
    try:
        got = rows()
    finally:
        spark.conf.unset(BROADCAST_CONF)
    assert set(kept[0].columns) == {"doc_id", "_sums", "_rest", "_row"}
    assert got.keys() == expected.keys() and set(got[0].asDict()) == {"doc_id", "vec"}
    for k, r in expected.items():
        assert (r.vec is None) == (got[k].vec is None) and (r.vec is None or np.allclose(r.vec, got[k].vec))
