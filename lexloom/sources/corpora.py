"""Readers of raw corpora. Schemas are explicit, so no file is read twice for inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import unnest
from ..operators.order import with_ordinal
from ..operators.rows import format_labelled, parse_labelled

# The record layouts of the raw corpora.
WIKI_SCHEMA = "title string, revision struct<text: string>"
RATINGS_SCHEMA = "id string, document string, label string"
QA_SCHEMA = (
    "data array<struct<title: string, paragraphs: array<struct<context: string, "
    "qas: array<struct<id: string, question: string, answers: array<struct<text: string>>>>>>>>"
)
REVIEW_SCHEMA = "movie_id string, review string"
PAIR_SCHEMA = "question1 string, question2 string, is_duplicate string"
LEXICON_SCHEMA = "word string, tag string"


def read_lines(spark: SparkSession, path) -> DataFrame:
    """(file, line_no, line): a line corpus with explicit keys.

    Large files are split between tasks; ``line_no`` grows with the position in the file but is
    not consecutive (``with_ordinal`` over (file, line_no) numbers the lines). Keys come from the
    file name and the row's place in its scan, so write the frame once before using them twice.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    keyed = lines.withColumn("file", F.col("_metadata.file_path")).withColumn(
        "line_no", F.col("_metadata.file_block_start") * F.lit(1 << 16) + F.monotonically_increasing_id() % F.lit(1 << 33)
    )
    return keyed.select("file", "line_no", "line")


def read_labelled_lines(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """``text␞label`` lines as (sound rows with a label column, corrupt rows)."""
    return parse_labelled(read_lines(spark, path))


def read_wiki_xml(spark: SparkSession, path) -> DataFrame:
    """(title, text): the pages of an XML dump, plain or bz2, markup removed."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(WIKI_SCHEMA).load(path)
    return pages.select("title", tx.strip_markup("revision.text").alias("text"))


def read_ratings(spark: SparkSession, path, with_label: bool) -> DataFrame:
    """Tab-separated ratings with a header: (id, line), with ``label`` when wanted."""
    rows = spark.read.schema(RATINGS_SCHEMA).csv(path, sep="\t", header=True, quote="", escape="")
    lines = rows.select("id", tx.strip_line(tx.collapse_ws(F.coalesce("document", F.lit("")))).alias("line"), "label")
    return lines if with_label else lines.drop("label")


def read_qa_json(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """(title, line): every context, question and answer of QA files (several paths merge).

    Published files are one document each (``multi_line``); one document per line splits better.
    """
    articles = unnest(spark.read.schema(QA_SCHEMA).json(path, multiLine=multi_line), [], "data", "d")
    paragraphs = unnest(articles, ["d.title"], "d.paragraphs", "p")
    questions = F.transform("p.qas", lambda q: q["question"])
    answers = F.flatten(F.transform("p.qas", lambda q: F.transform(q["answers"], lambda a: a["text"])))
    lines = unnest(paragraphs, ["title"], F.concat(F.array("p.context"), questions, answers), "line")
    return lines.withColumn("line", tx.strip_line(tx.collapse_ws("line")))


def read_review_json(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """(line, label): the reviews of a folder of JSON files, the item id as the label."""
    rows = spark.read.schema(REVIEW_SCHEMA).json(path, multiLine=multi_line)
    return rows.select(tx.strip_line(tx.collapse_ws("review")).alias("line"), F.col("movie_id").alias("label"))


def review_lines(reviews: DataFrame) -> DataFrame:
    """``review␞item_id`` lines."""
    return format_labelled(reviews).select("line")


def read_pairs_csv(spark: SparkSession, path) -> DataFrame:
    """Sentence pairs with their duplicate flag."""
    return spark.read.schema(PAIR_SCHEMA).csv(path, header=True, multiLine=True, escape='"')


def read_lexicon(spark: SparkSession, path) -> DataFrame:
    """(word, tag) of a lexicon or user dictionary."""
    return spark.read.schema(LEXICON_SCHEMA).csv(path)


def read_vectors(spark: SparkSession, path) -> DataFrame:
    """(word, vec) of a word-vector text file, tab or space separated; a header line is dropped."""
    fields = F.split(F.trim("value"), r"[ \t]+")
    rows = spark.read.text(path).select(fields.alias("f")).filter(F.size("f") > 2)
    return rows.select(
        F.element_at("f", 1).alias("word"),
        F.slice("f", F.lit(2), F.size("f") - 1).cast("array<float>").alias("vec"),
    )


def read_vocab(spark: SparkSession, path) -> DataFrame:
    """(id, token) of a vocabulary written by ``write_vocab``."""
    return spark.read.text(path).select(
        F.substring_index("value", "\t", 1).cast("bigint").alias("id"),
        F.expr("substring(value, instr(value, '\t') + 1)").alias("token"),
    )


def read_piece_tsv(spark: SparkSession, path) -> DataFrame:
    """(id, piece, score) of ``piece<TAB>score`` lines; the id is the place of the line."""
    fields = F.split("line", "\t")
    rows = with_ordinal(read_lines(spark, path), ["file", "line_no"], "id")
    return rows.select("id", fields[0].alias("piece"), F.get(fields, F.lit(1)).cast("double").alias("score"))
