"""Every stage of the pipeline against plain Python or SQL on what its predecessor left."""

import random
import sys

import brute
import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexloom.llm import mixing, quality
from lexloom.llm.oracles import ORACLES

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
import corpus_pipeline  # noqa: E402


def text_of(rnd):
    lines = []
    for _ in range(rnd.randint(1, 6)):
        lines.append(" ".join(f"w{rnd.randint(0, 5000)}" for _ in range(rnd.randint(2, 25))))
    return "\n".join(lines)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(11)
    texts = [text_of(rnd) for _ in range(60)]
    texts += texts[:6]  # exact copies
    for text in texts[6:16]:  # near copies, in one line each, so that lines do not repeat
        words = text.split()
        words[len(words) // 2] = "changed"
        texts += [" ".join(words), " ".join(words[:-1] + ["other"])]
    texts += ["again and again " * 20, "#&% " * 40, "too short", "", None, " \n "]
    license_line = "a line of at least ten words that many documents share"
    texts = [f"{t}\n{license_line}" if i % 4 == 0 and t else t for i, t in enumerate(texts)]
    rows = [(i, t, "en", rnd.choice(["a", "a", "b", None]), len(t or "")) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    return path


def covered_chars(words, n):
    seen = {}
    for i in range(len(words) - n + 1):
        seen.setdefault(tuple(words[i : i + n]), []).append(i)
    inside = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + n)}
    return sum(len(words[j]) for j in inside)


def keeps(text):
    words = brute.words(text)
    n_words, chars, symbols, _, _, failed = brute.quality_base(text)
    lines = [line for line in (text or "").split("\n") if brute.words(line)]
    doubled = sum(len(line) for i, line in enumerate(lines) if line in lines[:i])
    return not (
        failed
        or any(covered_chars(words, n) > share * chars for n, share in quality.NGRAM_SHARES.items())
        or doubled > quality.LINE_SHARE * sum(map(len, lines))
        or symbols > quality.SYMBOLS_PER_WORD * n_words
    )


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, made = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        path = str(tmp_path / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        after = [tuple(r) for r in docs.collect()]
        made[name] = (before, after)
        assert name == "encode" or docs.columns == columns
        assert 0 < len(after)

    before, after = made["quality"]
    assert sorted(after, key=str) == sorted((r for r in before if keeps(r[1])), key=str)

    before, after = made["line_dedup"]
    want = brute.dedup_lines([r[:2] for r in before], 10)
    changed = {r[0]: (want[r[0]][0], len(want[r[0]][0]) if want[r[0]][1] else r[4]) for r in before}
    assert sorted((r[0], r[1], r[4]) for r in after) == sorted((d, *x) for d, x in changed.items() if x[0] or not want[d][1])
    assert len(after) < len(before) and any(want[r[0]][1] for r in after)

    before, after = made["near_copies"]
    labels = brute.components([r[:2] for r in before], 5, 80)
    assert sorted(r[0] for r in after) == sorted({label for _, label in labels})
    assert len(after) < len(before) and set(after) <= set(before)

    before, after = made["mix"]
    documents = spark.createDataFrame(before, docs_schema()).toPandas()  # noqa: F841  read by the SQL below
    taken = duckdb.sql(f"SELECT doc_id, taken FROM ({ORACLES['op3_mix']}) t").fetchall()
    got = {}
    for r in after:
        got[r[0]] = got.get(r[0], 0) + len(brute.words(r[1]))
        assert r[4] == len(r[1])
    assert got == {d: n for d, n in taken if n}
    texts = {r[0]: r[1] for r in before}
    assert all(r[1] in texts[r[0]] for r in after)
    assert mixing.BLOCK > 0

    before, after = made["encode"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r[0], library.encode(r[1], add_special_tokens=False).ids) for r in before)
    assert sorted((r[0], list(r[4])) for r in after) == want
    assert all(r[3] == len(r[4]) for r in after)


def docs_schema():
    return "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_run_equals_its_stages(spark, folder):
    ran = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert sorted(map(str, ran.collect())) == sorted(map(str, docs.collect()))


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("1 = 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
