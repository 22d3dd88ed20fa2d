import bz2
import json

from pyspark.sql import functions as F

from lexloom import __main__ as cli
from lexloom.plans import catalog
from lexloom.sources import corpora, sinks
from lexloom.streaming.lines import clean_token_lines, stream_documents


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_lines_keep_their_order(spark, tmp_path):
    path = put(tmp_path / "c.txt", "b\n\na\n")
    rows = corpora.read_lines(spark, path).orderBy("line_no").collect()
    assert [r.line for r in rows] == ["b", "", "a"]


def test_wiki_dump(spark, tmp_path):
    page = "<page><title>T</title><revision><text>''x'' [[a|b]] {{z}}</text></revision></page>"
    path = tmp_path / "w.xml.bz2"
    path.write_bytes(bz2.compress(f"<mediawiki>{page}{page}</mediawiki>".encode()))
    assert [(r.title, r.text) for r in corpora.read_wiki_xml(spark, str(path)).collect()] == [("T", "x b")] * 2


def test_ratings(spark, tmp_path):
    path = put(tmp_path / "r.txt", 'id\tdocument\tlabel\n1\tgood "one\t1\n2\t\t0\n')
    rows = corpora.read_ratings(spark, path, True).orderBy("id").collect()
    assert [(r.line, r.label) for r in rows] == [('good "one', "1"), ("", "0")]
    assert corpora.read_ratings(spark, path, False).columns == ["id", "line"]


def test_qa_and_reviews(spark, tmp_path):
    qa = {"data": [{"title": "t", "paragraphs": [{"context": "c  d", "qas": [{"id": "1", "question": "q", "answers": [{"text": "a"}]}]}]}]}
    paths = [put(tmp_path / n, json.dumps(qa, indent=1)) for n in ("train.json", "dev.json")]
    assert sorted(r.line for r in corpora.read_qa_json(spark, paths).collect()) == sorted(["c d", "q", "a"] * 2)
    folder = tmp_path / "raw"
    folder.mkdir()
    put(folder / "1.json", json.dumps([{"movie_id": "7", "review": "fine\nfilm"}, {"movie_id": "7", "review": "bad"}], indent=1))
    reviews = corpora.read_review_json(spark, str(folder))
    assert sorted(r.line for r in corpora.review_lines(reviews).collect()) == ["bad␞7", "fine film␞7"]


def test_pairs_lexicon_vectors(spark, tmp_path):
    pairs = put(tmp_path / "p.csv", 'question1,question2,is_duplicate\n"a, b","c ""d""",1\n')
    assert tuple(corpora.read_pairs_csv(spark, pairs).first()) == ("a, b", 'c "d"', "1")
    assert corpora.read_lexicon(spark, put(tmp_path / "l.csv", "집,NNG\n")).first().tag == "NNG"
    vecs = put(tmp_path / "v.txt", "2 3\na 1 2 3\nb 4 5 6.5\n")
    assert {r.word: r.vec for r in corpora.read_vectors(spark, vecs).collect()} == {"a": [1, 2, 3], "b": [4, 5, 6.5]}
    tsv = put(tmp_path / "s.vocab", "<unk>\t0\n▁a\t-1.5\n")
    assert [(r.id, r.piece, r.score) for r in corpora.read_piece_tsv(spark, tsv).orderBy("id").collect()] == [(0, "<unk>", 0.0), (1, "▁a", -1.5)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(0, i, ["t", str(i)], "1") for i in range(20)], "doc_id int, line_no int, tokens array<string>, label string")
    sinks.write_lines(df.repartition(5), str(tmp_path / "l"), col="tokens")
    text = "".join(p.read_text() for p in sorted((tmp_path / "l").glob("part-*")))
    assert text.splitlines() == [f"t {i}" for i in range(20)]
    sinks.write_labelled_lines(df, str(tmp_path / "m"), col="tokens")
    good, corrupt = corpora.read_labelled_lines(spark, str(tmp_path / "m"))
    assert good.count() == 20 and corrupt.count() == 0
    words = spark.createDataFrame([(1, "b c"), (0, "a")], "id bigint, token string")
    sinks.write_vocab(words, str(tmp_path / "v"))
    assert sorted(map(tuple, corpora.read_vocab(spark, str(tmp_path / "v")).collect())) == [(0, "a"), (1, "b c")]
    sinks.write_token_list(words, str(tmp_path / "t"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))) == "a\nb c\n"
    shards = df.withColumn("ordinal", F.col("line_no")).withColumn("shard", F.floor(F.col("line_no") / 8))
    sinks.write_shards(shards, str(tmp_path / "s"), col="tokens")
    assert sorted(p.name for p in (tmp_path / "s").glob("shard=*")) == ["shard=0", "shard=1", "shard=2"]


def test_stream_equals_batch(spark, data, tmp_path):
    docs = catalog.documents(spark, data)
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    query = (
        clean_token_lines(stream_documents(spark, str(tmp_path / "in"), docs.schema))
        .writeStream.format("memory").queryName("cleaned").outputMode("append").start()
    )
    query.processAllAvailable()
    query.stop()
    streamed = sorted(map(str, spark.table("cleaned").collect()))
    assert streamed == sorted(map(str, clean_token_lines(docs).collect()))


def run(job, spark, **pairs):
    fn = cli.available()[job]
    fn(spark, **cli.arguments(fn, [f"{k}={v}" for k, v in pairs.items()]))


def test_jobs_from_lines_to_records(spark, data, tmp_path):
    at = lambda n: str(tmp_path / n)
    lines = catalog.lines(spark, data)
    sinks.write_lines(lines.filter("line <> ''"), at("raw"))
    labelled = lines.withColumn("label", (F.col("doc_id") % 2).cast("string")).filter("line <> ''")
    sinks.write_labelled_lines(labelled.filter("doc_id % 4 < 3"), at("train"))
    sinks.write_labelled_lines(labelled.filter("doc_id % 4 = 3"), at("test"))
    run("tokenize", spark, input=at("raw"), output=at("tok"), tokenizer="whitespace")
    run("merge", spark, inputs=f"{at('tok')},{at('tok')}", output=at("merged"))
    assert spark.read.text(at("merged")).count() == 2 * spark.read.text(at("tok")).count()
    run("train-space", spark, input=at("raw"), model=at("space"))
    run("apply-space-correct", spark, input=at("test"), model=at("space"), output=at("fixed"), with_label="True")
    assert spark.read.text(at("fixed")).count() == spark.read.text(at("test")).count()
    run("word-scores", spark, input=at("raw"), model=at("scores"))
    run("score-tokenize", spark, input=at("raw"), model=at("scores"), output=at("ltok"))
    run("jamo", spark, input=at("tok"), output=at("jamo"))
    run("random-vectors", spark, input=at("tok"), output=at("vec"), dim="8")
    run("cbow", spark, train=at("train"), test=at("test"), vectors=at("vec"), output=at("cbow"), corpus=at("tok"))
    assert 0 <= sinks.load_table(spark, at("cbow_accuracy")).first().accuracy <= 1
    run("bert-vocab", spark, input=at("raw"), vocab_path=at("bv"), size="130")
    run("bert-tokenize", spark, input=at("raw"), vocab_path=at("bv"), output=at("btok"))
    run("bert-data", spark, input=at("raw"), vocab_path=at("bv"), output=at("records"))
    assert sinks.load_table(spark, at("records")).count() > 0
    run("elmo-data", spark, inputs=at("tok"), output=at("elmo"))
    assert sinks.load_table(spark, at("elmo/vocab")).filter("id < 3").count() == 3


def test_lines_are_made_once_when_they_are_written(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def line(n):
        made.add(1)
        return f"line {n}"

    rows = spark.range(40).select(F.lit(0).alias("doc_id"), F.col("id").alias("line_no"), F.udf(line, "string")("id").alias("line"))
    sinks.write_lines(rows, str(tmp_path / "l"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "l").glob("part-*")))
    assert text.splitlines() == [f"line {n}" for n in range(40)]
    assert made.value == 40
