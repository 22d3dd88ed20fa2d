"""Jobs from files to files."""

import json

import pytest

from lexloom.operators import tokenizers
from lexloom.plans import jobs


@pytest.fixture
def corpus(tmp_path):
    """Forty documents of several sentences, parted by blank lines, in two files."""
    for part in range(2):
        docs = [
            "\n".join(" ".join(f"d{part}x{d} s{s} tail word{s * 7 % 5} tail." for _ in range(4)) + f" More of s{s}." for s in range(4))
            for d in range(20)
        ]
        (tmp_path / f"part{part}.txt").write_text("\n\n".join(docs) + "\n")
    return str(tmp_path / "part*.txt"), tmp_path


def lines_of(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def vocabulary(spark, path, lines):
    words = sorted({w for line in lines for w in line.replace(".", " .").split()})
    rows = [(i, t) for i, t in enumerate(["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", *words, "##."])]
    spark.createDataFrame(rows, "id bigint, token string").write.parquet(path)


def test_documents_keep_their_boundaries(spark, corpus):
    source, folder = corpus
    jobs.process_documents(spark, source, str(folder / "sentences"))
    made = lines_of(spark, str(folder / "sentences"))
    assert made.count("") == 38
    assert all(line.count(".") == 1 for line in made if line)


def test_records_of_documents(spark, corpus):
    source, folder = corpus
    vocabulary(spark, str(folder / "vocab"), lines_of(spark, source))
    jobs.bert_data(spark, source, str(folder / "vocab"), str(folder / "records"))
    rows = spark.read.parquet(str(folder / "records")).filter("copy = 1").collect()
    assert len({r.doc_id for r in rows}) == 40
    assert 0.3 < sum(r.is_random_next for r in rows) / len(rows) < 0.8
    for r in rows:
        assert len(r.tokens) <= 128 and r.tokens[0] == "[CLS]"


def test_windows_of_documents_hold_ids(spark, corpus):
    source, folder = corpus
    pieces = sorted({"▁" + w for line in lines_of(spark, source) for w in line.split()})
    rows = [(i, p, -1.0 - i / 1000, "piece") for i, p in enumerate(pieces)]
    spark.createDataFrame(rows, "id bigint, piece string, score double, kind string").write.parquet(str(folder / "pieces"))
    jobs.xlnet_data(spark, source, str(folder / "pieces"), str(folder / "windows"))
    made = spark.read.parquet(str(folder / "windows"))
    assert made.select("doc_id").distinct().count() == 40
    assert made.filter("direction = 'forward' AND pass = 1 AND win = 0").first().ids[0] in range(len(pieces))
    assert made.select("pass").distinct().count() == 10


def test_dictionary_tokens(spark, corpus, tmp_path):
    (tmp_path / "lexicon.csv").write_text("cat,N\nsat,V\n")
    (tmp_path / "user.csv").write_text("cat,X\n")
    (tmp_path / "in.txt").write_text("cat sat cats\n")
    paths = [str(tmp_path / n) for n in ("in.txt", "lexicon.csv", "out", "user.csv")]
    jobs.lexicon_tokenize(spark, *paths, pos=True)
    assert lines_of(spark, str(tmp_path / "out")) == ["cat/X sat/V cat/X s/UNK"]


def test_vocabulary_files(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["[PAD]", "a", "##b", "c d"])]
    spark.createDataFrame(rows, "id bigint, token string").repartition(3).write.parquet(str(tmp_path / "v"))
    jobs.vocab_export(spark, str(tmp_path / "v"), str(tmp_path / "txt"))
    jobs.vocab_import(spark, str(tmp_path / "txt"), str(tmp_path / "w"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "w")).collect())) == rows
    (tmp_path / "p.tsv").write_text("<unk>\t0\n▁ab\t-1\nc\t-2\n")
    jobs.pieces_import(spark, str(tmp_path / "p.tsv"), str(tmp_path / "q"))
    assert [r.token for r in spark.read.parquet(str(tmp_path / "q")).orderBy("id").collect()][5:] == ["ab", "##c"]


def test_word_and_document_vectors(spark, corpus):
    source, folder = corpus
    for job, more in ((jobs.word2vec, {"dim": 4}), (jobs.glove, {"dim": 4}), (jobs.lsa, {"dim": 4}), (jobs.lsa_tfidf, {"dim": 4}), (jobs.lda, {"topics": 3})):
        job(spark, source, str(folder / job.__name__), **more)
        assert spark.read.parquet(str(folder / job.__name__)).count() > 10


def test_raw_corpora_to_lines(spark, tmp_path):
    (tmp_path / "wiki.xml").write_text("<mediawiki><page><title>t</title><revision><text>a [[b|c]] {{x|{{y}}}} d</text></revision></page></mediawiki>")
    jobs.process_wiki(spark, str(tmp_path / "wiki.xml"), str(tmp_path / "wiki"))
    assert lines_of(spark, str(tmp_path / "wiki")) == ["a c d"]
    (tmp_path / "ratings.tsv").write_text("id\tdocument\tlabel\n1\tgood  film\t1\n2\tbad\t0\n")
    jobs.process_ratings(spark, str(tmp_path / "ratings.tsv"), str(tmp_path / "plain"))
    jobs.process_ratings(spark, str(tmp_path / "ratings.tsv"), str(tmp_path / "labelled"), with_label=True)
    assert sorted(lines_of(spark, str(tmp_path / "plain"))) == ["bad", "good film"]
    assert sorted(lines_of(spark, str(tmp_path / "labelled"))) == ["bad␞0", "good film␞1"]
    qa = {"data": [{"title": "t", "paragraphs": [{"context": "some text", "qas": [{"id": "1", "question": "why", "answers": [{"text": "so"}]}]}]}]}
    (tmp_path / "qa.json").write_text(json.dumps(qa))
    jobs.process_qa(spark, [str(tmp_path / "qa.json")], str(tmp_path / "qa"))
    assert sorted(lines_of(spark, str(tmp_path / "qa"))) == ["so", "some text", "why"]
    (tmp_path / "reviews").mkdir()
    (tmp_path / "reviews" / "1.json").write_text(json.dumps([{"movie_id": "7", "review": "fine film"}]))
    jobs.process_reviews(spark, str(tmp_path / "reviews"), str(tmp_path / "tagged"))
    assert lines_of(spark, str(tmp_path / "tagged")) == ["fine film␞7"]


def test_trained_vectors_and_tags(spark, corpus):
    source, folder = corpus
    jobs.swivel(spark, source, str(folder / "swivel"), dim=4)
    (folder / "unseen.txt").write_text("words s1 qqq\n")
    jobs.fasttext(spark, source, str(folder / "fasttext"), dim=4, unseen=str(folder / "unseen.txt"))
    words = {r.word for r in spark.read.parquet(str(folder / "swivel")).collect()}
    assert words == {r.word for r in spark.read.parquet(str(folder / "fasttext")).collect()} and "s1" in words
    assert {r.word for r in spark.read.parquet(str(folder / "fasttext_unseen")).collect()} == {"words"}
    (folder / "tags.txt").write_text("".join(f"a{i % 5} b{i % 7} same␞{'left' if i % 2 else 'right'}\n" for i in range(80)))
    jobs.doc2vec(spark, str(folder / "tags.txt"), str(folder / "tagvec"), dim=4)
    assert {r.label: len(r.vec) for r in spark.read.parquet(str(folder / "tagvec")).collect()} == {"left": 4, "right": 4}


def test_labels_by_vectors(spark, tmp_path):
    for name, n in (("train", 60), ("test", 20)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{'good fine' if i % 2 else 'bad poor'} film␞{i % 2}\n" for i in range(n)))
    rows = [("good", [1.0, 0.0]), ("fine", [0.9, 0.1]), ("bad", [0.0, 1.0]), ("poor", [0.1, 0.9]), ("film", [0.1, 0.1])]
    spark.createDataFrame(rows, "word string, vec array<float>").write.parquet(str(tmp_path / "vectors"))
    paths = [str(tmp_path / n) for n in ("train.txt", "test.txt", "vectors")]
    for job in (jobs.cbow, jobs.tune):
        job(spark, *paths, str(tmp_path / job.__name__))
        told = spark.read.parquet(str(tmp_path / job.__name__) + "_accuracy").first()
        assert (told.n, told.accuracy) == (20, 1.0)
    jobs.cbow(spark, *paths, str(tmp_path / "weighted"), corpus=paths[0])
    assert spark.read.parquet(str(tmp_path / "weighted_accuracy")).first().accuracy == 1.0


def test_language_model_vocabularies(spark, corpus):
    source, folder = corpus
    jobs.xlnet_vocab(spark, source, str(folder / "pieces"), 120)
    pieces = spark.read.parquet(str(folder / "pieces")).orderBy("id").collect()
    assert [r.piece for r in pieces[:4]] == ["<unk>", "<s>", "</s>", "<cls>"] and len(pieces) <= 120
    jobs.elmo_data(spark, [source], str(folder / "elmo"))
    assert [r.token for r in spark.read.parquet(str(folder / "elmo" / "vocab")).orderBy("id").limit(3).collect()] == ["<S>", "</S>", "<UNK>"]
    assert spark.read.text(str(folder / "elmo" / "shards")).count() == len(lines_of(spark, source))


def test_least_cost_morphs(spark, tmp_path):
    (tmp_path / "tagged.txt").write_text("cat/N+s/J sat/V\ncat/N sat/V+s/J\n" * 5)
    jobs.morph_costs(spark, str(tmp_path / "tagged.txt"), str(tmp_path / "costs"))
    (tmp_path / "in.txt").write_text("cats sats dog\n")
    jobs.morph_tokenize(spark, str(tmp_path / "in.txt"), str(tmp_path / "costs"), str(tmp_path / "out"), pos=True)
    assert lines_of(spark, str(tmp_path / "out")) == ["cat/N s/J sat/V s/J dog/SL"]


def test_unknown_names_use_the_default(spark):
    df = spark.createDataFrame([(1, 0, "a-b c")], "doc_id bigint, line_no bigint, line string")
    assert tokenizers.tokenize(df, "no such analyzer").first().tokens == ["a", "-", "b", "c"]
