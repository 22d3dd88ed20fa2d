"""Every operator as a query over the supplied tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.hangul import normalize_repeats, to_jamo
from ..functions.vectors import cosine, dot, mean_vectors, norm, random_vector
from ..operators import cooccur, embed, factorize, lattice, order, pairmerge, paragraph, pretrain, rows, sentences, sentvec, sets, skipgram, spacing, subword, swivel, tokenizers, topics, unigram, vocab, wordscore
from ..functions.arrays import unnest
from ..session import cut_lineage, shared_folder, spread, stored
from ..sources import corpora, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIM = 100  # of all vectors
LATIN = "abcdefghijklmnopqrstuvwxyz"
# The supplied text holds no Hangul: letters stand for these syllables and bare letters.
SYLLABLES = "가각힣값나닭다라마바사아자차카타파하뷁쿠ㅋㅜㅎㅏ뎅굣"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text", "source")


def lines(spark, folder):
    return rows.explode_lines(documents(spark, folder))


def tokens(spark, folder):
    """White-space tokens of every line, digits apart."""
    return tokenizers.tokenize(lines(spark, folder), "whitespace").drop("line")


def doc_tokens(spark, folder):
    """White-space tokens of every whole document."""
    return documents(spark, folder).select("doc_id", "source", tx.split_tokens("text").alias("tokens"))


def scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def keyed(df: DataFrame, *cols) -> DataFrame:
    """(doc_id, line_no, ...) with BIGINT keys."""
    return df.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), *cols)


def joined(col) -> F.Column:
    return F.array_join(col, " ")


def rounded(col, digits: int = 6):
    return F.round(col, digits)


def numbers(col: str, digits: int = 5):
    """A vector as text, so that both engines compare the same rounded numbers."""
    return F.array_join(F.transform(col, lambda v: F.round(v.cast("double"), digits).cast("decimal(18,%d)" % digits).cast("string")), " ")


# ---------------------------------------------------------------- sources and sinks


@query
def s01_lines(spark, folder):
    return keyed(lines(spark, folder), "line")


@query
def s02_labelled_lines(spark, folder):
    """Every fifth line comes without its label and must end up as corrupt."""
    raw = lines(spark, folder).join(table(spark, folder, "labels"), "doc_id")
    text = F.when(F.col("line_no") % 5 == 4, F.col("line")).otherwise(
        F.concat_ws(tx.LABEL_MARK, "line", F.col("quality").cast("string"))
    )
    good, corrupt = rows.parse_labelled(raw.select("doc_id", "line_no", text.alias("line")))
    both = good.withColumn("status", F.lit("ok")).unionByName(corrupt.withColumn("status", F.lit("corrupt")), True)
    return keyed(both, "line", "label", "status")


@query
def s03_wiki_xml(spark, folder):
    path = scratch(spark)
    pages = table(spark, folder, "pages").select(F.col("url").alias("title"), F.struct(F.col("html").alias("text")).alias("revision"))
    pages.write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").option("compression", "bzip2").save(path)
    return corpora.read_wiki_xml(spark, path)


@query
def s04_ratings(spark, folder):
    path = scratch(spark)
    docs = documents(spark, folder).join(table(spark, folder, "labels"), "doc_id")
    rated = docs.select(
        F.col("doc_id").cast("string").alias("id"), tx.collapse_ws("text").alias("document"), F.col("quality").cast("string").alias("label")
    )
    rated.write.csv(path, sep="\t", header=True, quote="", escape="", escapeQuotes=False)
    return corpora.read_ratings(spark, path, with_label=True)


@query
def s05_qa_json(spark, folder):
    path = scratch(spark)
    turns = table(spark, folder, "conversations")
    answer = F.array(F.struct(F.col("role").alias("text")))
    qas = F.array(F.struct(F.col("turn").cast("string").alias("id"), F.concat(F.lit("who says "), "turn").alias("question"), answer.alias("answers")))
    paragraph = F.array(F.struct(F.col("text").alias("context"), qas.alias("qas")))
    articles = turns.select(F.array(F.struct(F.col("conv_id").cast("string").alias("title"), paragraph.alias("paragraphs"))).alias("data"))
    articles.write.json(path)
    return corpora.read_qa_json(spark, path, multi_line=False)


@query
def s06_review_json(spark, folder):
    path = scratch(spark)
    documents(spark, folder).select(F.col("source").alias("movie_id"), F.col("text").alias("review")).write.json(path)
    return corpora.review_lines(corpora.read_review_json(spark, path, multi_line=False))


@query
def s07_pairs_csv(spark, folder):
    path = scratch(spark)
    turns = table(spark, folder, "conversations")
    turns.select(
        F.col("text").alias("question1"), F.concat_ws(" ", "role", "text").alias("question2"), (F.col("turn") % 2).cast("string").alias("is_duplicate")
    ).write.csv(path, header=True, escape='"', quoteAll=True)
    return corpora.read_pairs_csv(spark, path)


def word_vectors(spark, folder, dim: int = DIM, min_count: int = 5) -> DataFrame:
    """Reproducible start vectors of the vocabulary words."""
    words = vocab.token_counts(doc_tokens(spark, folder)).filter(F.col("cnt") >= min_count)
    words = cut_lineage(words.select("word"))  # a vector takes far longer than a word: in a task for each core
    return spread(words).select("word", random_vector(F.col("word"), dim).alias("vec"))


@query
def s08_read_vectors(spark, folder):
    path = scratch(spark)
    short = F.transform("vec", lambda v: F.round(v, 4))
    sinks.write_vectors(word_vectors(spark, folder).select("word", short.alias("vec")), path)
    return corpora.read_vectors(spark, path).select("word", numbers("vec").alias("vec"))


@query
def s09_write_lines(spark, folder):
    path = scratch(spark)
    sinks.write_lines(tokens(spark, folder), path, col="tokens")
    return corpora.read_lines(spark, path).groupBy("line").agg(F.count("*").alias("cnt"))


@query
def s10_labelled_strings(spark, folder):
    labelled = lines(spark, folder).join(table(spark, folder, "labels"), "doc_id").withColumn("label", F.col("quality").cast("string"))
    return keyed(rows.format_labelled(labelled), "line")


@query
def s11_write_vocab(spark, folder):
    path = scratch(spark)
    words = vocab.word_ids(vocab.token_counts(tokens(spark, folder)).filter("cnt >= 5"))
    sinks.write_vocab(words.select("id", F.col("word").alias("token")), path)
    return corpora.read_vocab(spark, path)


@query
def s12_model_table(spark, folder):
    path = scratch(spark)
    sinks.save_table(vocab.token_counts(tokens(spark, folder)), path)
    return sinks.load_table(spark, path)


@query
def s13_shards(spark, folder):
    shards = order.shard_documents(documents(spark, folder), 1000)
    return keyed(shards, "ordinal", "shard")


# ---------------------------------------------------------------- rows


@query
def r01_strip(spark, folder):
    padded = lines(spark, folder).withColumn("line", F.concat(F.lit("\t  "), "line", F.lit(" 　\n")))
    return keyed(padded, tx.strip_line("line").alias("line"))


@query
def r02_drop_blank(spark, folder):
    """The lines that are blank once letters from n to z are gone."""
    thinned = lines(spark, folder).withColumn("line", tx.strip_line(F.regexp_replace("line", "[n-zA-Z., ]", "")))
    return keyed(rows.drop_blank(thinned), "line")


@query
def r03_with_label(spark, folder):
    labelled = lines(spark, folder).join(table(spark, folder, "labels"), "doc_id")
    clean = rows.with_label(labelled, lambda c: tx.collapse_ws(tx.strip_line(c)))
    return keyed(clean, "line", F.col("quality").cast("string").alias("label"))


@query
def r04_collapse_spaces(spark, folder):
    return documents(spark, folder).select("doc_id", tx.collapse_ws("text").alias("text"))


@query
def r05_limit_repeats(spark, folder):
    """Longest run of one letter per line after the clean-up, and the cleaned length."""
    clean = lines(spark, folder).select("doc_id", "line_no", normalize_repeats("line", 3).alias("line"))
    return keyed(clean, "line")


@query
def r06_split_digits(spark, folder):
    split = lines(spark, folder).withColumn("tokens", tx.split_digits(tx.split_tokens("line")))
    return keyed(split, joined("tokens").alias("line"))


def hangul_lines(spark, folder):
    lowered = F.translate(F.lower("line"), LATIN, SYLLABLES)
    return lines(spark, folder).select("doc_id", "line_no", lowered.alias("line"))


@query
def r07_to_jamo(spark, folder):
    return keyed(hangul_lines(spark, folder), to_jamo("line").alias("line"))


@query
def r08_clean_text(spark, folder):
    return documents(spark, folder).select("doc_id", tx.clean_text("text").alias("text"))


@query
def r09_strip_markup(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.strip_markup("html").alias("text"))


@query
def r09_nested_markup(spark, folder):
    """Pages between templates, tables and links of up to twenty levels, some marks left open."""
    deep = lambda mark, n: F.repeat(F.lit(mark), n)
    n = (F.col("page_id") % 20 + 1).cast("int")
    start = F.regexp_replace(F.substring("html", 1, 200), r"[\[\]{}|<>&='\n]", " ")
    parts = [deep("{{a|", n), start, deep("}}", n), F.lit(" b "), deep("[[c|", n), F.col("url"), deep("]]", n), deep("{|", n), start]
    parts += [deep("|}", n), F.lit("[[File:x|[[y|"), F.col("url"), F.lit("]]]] {{open "), start, F.lit("<nowiki>[[z]]</nowiki> ]]")]
    return table(spark, folder, "pages").select("page_id", tx.strip_markup(F.concat(*parts)).alias("text"))


@query
def r10_abbreviations(spark, folder):
    counts = cut_lineage(sentences.period_counts(documents(spark, folder)))
    return sentences.abbreviations(counts).select("word", "n_period", "n_plain", F.round("score", 4).alias("score"))


@query
def r10_learned_sentences(spark, folder):
    found = sentences.to_sentences(documents(spark, folder))
    return found.select("doc_id", F.col("sent_no").cast("bigint").alias("sent_no"), "sentence")


@query
def r10_sentences(spark, folder):
    found = rows.to_sentences(documents(spark, folder))
    return found.select("doc_id", F.col("sent_no").cast("bigint").alias("sent_no"), "sentence")


def tagged_tokens(spark, folder):
    return tokenizers.lexicon_tokenize(tokens(spark, folder), lexicon(spark, folder))


@query
def r11_format_pos(spark, folder):
    """Tagged tokens rendered with their tags; digits are put apart in the tagged strings too."""
    tagged = tagged_tokens(spark, folder)
    shown = tx.split_digits(rows.format_pos("tagged", pos=True))
    plain = tx.split_digits(rows.format_pos("tagged"))
    return keyed(tagged, joined(shown).alias("tagged"), joined(plain).alias("plain"))


# ---------------------------------------------------------------- tokenizers


@query
def t01_tokenize(spark, folder):
    return keyed(tokens(spark, folder), joined("tokens").alias("tokens"), F.size("tokens").cast("bigint").alias("n"))


def lexicon(spark, folder) -> DataFrame:
    """Frequent words of up to six characters, tagged by their length."""
    counts = vocab.token_counts(doc_tokens(spark, folder)).filter((F.col("cnt") >= 20) & (F.length("word") <= 6))
    return counts.select("word", F.when(F.length("word") <= 2, "J").otherwise("N").alias("tag"))


@query
def t02_lexicon_tokens(spark, folder):
    shown = rows.format_pos("tagged", pos=True)
    return keyed(tagged_tokens(spark, folder), joined(shown).alias("tagged"))


@query
def t02_lattice(spark, folder):
    """Least-cost paths under costs estimated from the dictionary tokens of the same documents; every
    character of a line is in its morphs."""
    corpus = stored(tokens(spark, folder))
    words = tokenizers.lexicon_tokenize(corpus, lexicon(spark, folder))
    each = unnest(words, [], F.transform("tagged", lambda m: F.array(m)), "pieces")
    costs, connections = lattice.estimate_costs(each)
    shown = rows.format_pos("tagged", pos=True)
    return keyed(lattice.lattice_tokenize(corpus, costs, connections), joined(shown).alias("tagged"))


@query
def t03_merge_lexicon(spark, folder):
    counts = vocab.token_counts(tokens(spark, folder))
    user = counts.filter(F.col("cnt") >= 50).select("word", F.lit("NNP").alias("tag"))
    base = counts.filter(F.col("cnt") >= 10).select("word", F.lit("NNG").alias("tag"))
    return tokenizers.merge_lexicon(base, user)


@query
def t04_l_tokens(spark, folder):
    scores = cut_lineage(wordscore.word_scores(tokens(spark, folder)))
    split = tokenizers.l_tokenize(lines(spark, folder), scores)
    return keyed(split, joined("tokens").alias("tokens"))


def greedy_vocab(spark, folder) -> DataFrame:
    """Frequent token beginnings as pieces, frequent endings as continuations."""
    counts = vocab.token_counts(lines(spark, folder).select(tx.split_punctuation("line").alias("tokens")))
    sized = unnest(counts, ["cnt", "word"], F.sequence(F.lit(1), F.least(F.length("word"), F.lit(6))), "n")
    begin = sized.select(F.substring(F.col("word"), F.lit(1), F.col("n")).alias("token"), "cnt")
    end = sized.select(
        F.concat(F.lit("##"), F.substr(F.col("word"), F.length("word") - F.col("n") + 1)).alias("token"), "cnt"
    )
    pieces = begin.unionByName(end).groupBy("token").agg(F.sum("cnt").alias("cnt"))
    return pieces.filter(F.col("cnt") >= 20).select("token", "cnt")


@query
def t05_wordpiece(spark, folder):
    pieces = cut_lineage(greedy_vocab(spark, folder))
    return keyed(subword.wordpiece(lines(spark, folder), pieces), joined("tokens").alias("tokens"))


@query
def t05_trained_wordpiece(spark, folder):
    """Training, vocabulary and matching in a chain: pieces of the documents cut the documents."""
    pieces = subword.to_bert_vocab(pairmerge.bpe_train(lines(spark, folder)))
    return keyed(subword.wordpiece(lines(spark, folder), cut_lineage(pieces)), joined("tokens").alias("tokens"))


def unigram_vocab(spark, folder) -> DataFrame:
    return unigram.unigram_train(lines(spark, folder))


def short_pieces(words: DataFrame) -> DataFrame:
    """(piece, score): frequent substrings of up to four characters with the logarithm of their share."""
    sized = unnest(words, ["word", "cnt"], F.sequence(F.lit(1), F.length("word")), "at")
    sized = unnest(sized, ["word", "cnt", "at"], F.sequence(F.lit(1), F.least(F.lit(4), F.length("word") - F.col("at") + 1)), "n")
    counts = sized.groupBy(F.substr("word", F.col("at"), F.col("n")).alias("piece")).agg(F.sum("cnt").alias("n")).filter("n >= 50")
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.select("piece", F.round(F.ln(F.col("n") / total), 6).alias("score"))


@query
def t06_short_pieces(spark, folder):
    """The best segmentations under a table of short pieces."""
    words = tokens_marked(spark, folder)
    pieces = cut_lineage(short_pieces(words).withColumn("kind", F.lit("piece")))
    return keyed(unigram.unigram_encode(lines(spark, folder), pieces), joined("tokens").alias("tokens"))


def tokens_marked(spark, folder) -> DataFrame:
    return cut_lineage(unigram.training_words(lines(spark, folder), user=()))


@query
def t06_unigram_encode(spark, folder):
    pieces = unigram_vocab(spark, folder)
    return keyed(unigram.unigram_encode(lines(spark, folder), pieces), joined("tokens").alias("tokens"))


@query
def t07_encode_ids(spark, folder):
    corpus = tokens(spark, folder)
    words = vocab.word_ids(vocab.token_counts(corpus).filter("cnt >= 5"), 1)
    coded = tokenizers.encode_ids(corpus, words.select(F.col("word").alias("token"), "id"), unknown=0)
    return keyed(coded, F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


# ---------------------------------------------------------------- statistics


@query
def a01_vocab_count(spark, folder):
    return vocab.vocab_count(tokens(spark, folder))


@query
def a02_lm_vocab(spark, folder):
    return vocab.lm_vocab(tokens(spark, folder))


@query
def a03_char_coverage(spark, folder):
    return vocab.char_coverage(lines(spark, folder))


@query
def a04_bpe_train(spark, folder):
    return pairmerge.bpe_train(lines(spark, folder))


@query
def a05_unigram_train(spark, folder):
    return unigram_vocab(spark, folder).select("id", "piece", rounded("score").alias("score"), "kind")


@query
def a05_seeds(spark, folder):
    """The repeats that training starts from."""
    return unigram.repeated_substrings(tokens_marked(spark, folder))


@query
def a05_expected_counts(spark, folder):
    """One step of expectation under a table of short pieces."""
    words = tokens_marked(spark, folder)
    found = unigram.expected_counts(words, cut_lineage(short_pieces(words)))
    return found.select("piece", F.round(F.col("n").cast("double") / unigram.MICRO, 2).alias("n"))


@query
def a06_bert_vocab(spark, folder):
    """Words that start like a piece and word endings, in frequency order, as a piece table."""
    counts = vocab.token_counts(tokens(spark, folder)).filter("cnt >= 10")
    marked = counts.select(
        F.when(F.col("cnt") % 2 == 0, F.concat(F.lit("▁"), "word")).otherwise(F.col("word")).alias("word"), "cnt"
    )
    pieces = vocab.word_ids(marked).select("id", F.col("word").alias("piece"))
    return subword.to_bert_vocab(pieces)


@query
def a07_prefix_counts(spark, folder):
    return wordscore.prefix_counts(tokens(spark, folder))


@query
def a08_cohesion(spark, folder):
    scored = wordscore.cohesion_forward(cut_lineage(wordscore.prefix_counts(tokens(spark, folder))))
    return scored.select("word", "freq", rounded("cohesion_forward").alias("cohesion_forward"))


@query
def a09_entropy(spark, folder):
    scored = wordscore.right_branching_entropy(wordscore.prefix_counts(tokens(spark, folder)))
    return scored.select("word", rounded("right_branching_entropy").alias("right_branching_entropy"))


@query
def a10_word_scores(spark, folder):
    scored = wordscore.word_scores(tokens(spark, folder))
    return scored.select(
        "word", "freq", *[rounded(c).alias(c) for c in ("cohesion_forward", "right_branching_entropy", "score")]
    )


@query
def a11_spacing_train(spark, folder):
    return spacing.spacing_train(lines(spark, folder))


@query
def a12_spacing_apply(spark, folder):
    """Documents whose spaces after e and n were lost, corrected by the model of all documents."""
    model = cut_lineage(spacing.spacing_train(lines(spark, folder)))
    lost = lines(spark, folder).withColumn("line", F.regexp_replace("line", "([en]) +", "$1"))
    return keyed(spacing.spacing_apply(lost, model), "line")


def id_vocab(spark, folder) -> DataFrame:
    """(id, word, cnt) of the words seen five times or more."""
    return cut_lineage(vocab.word_ids(vocab.token_counts(tokens(spark, folder)).filter("cnt >= 5")))


@query
def a13_cooccurrence(spark, folder):
    cells = cooccur.cooccurrence(tokens(spark, folder), id_vocab(spark, folder))
    return cells.select("w1", "w2", rounded("x").alias("x"))


def id_cells(spark, folder, window: int = 15) -> tuple[DataFrame, DataFrame]:
    """Cells that are read several times, and their vocabulary."""
    words = id_vocab(spark, folder)
    return cooccur.cooccurrence_ids(tokens(spark, folder), words, window, keep=True), words


@query
def a14_shuffle(spark, folder):
    return order.shuffle_records(vocab.token_counts(tokens(spark, folder)), ["word"])


@query
def a15_pmi(spark, folder):
    cells, _ = id_cells(spark, folder, window=5)
    scored = cooccur.pmi(cells, n_shards=16)
    return scored.select("i", "j", rounded("x").alias("x"), rounded("pmi").alias("pmi"), "row_shard", "col_shard")


@query
def a15_marginals(spark, folder):
    words = id_vocab(spark, folder)
    cells = cooccur.cooccurrence_ids(tokens(spark, folder), words, 5)
    totals = cooccur.cooc_marginals(cells, "i").withColumnRenamed("i", "id")
    return totals.join(words, "id").select("word", rounded("total").alias("total"))


@query
def a16_tfidf(spark, folder):
    weights = cooccur.tfidf(doc_tokens(spark, folder))
    return weights.select("doc_id", "word", "tf", rounded("weight").alias("weight"))


# ---------------------------------------------------------------- embeddings and topics


def shape_of(vectors: DataFrame, key: str) -> DataFrame:
    """What holds for every trained vector whatever its numbers: its row, its length, finite and not all zero."""
    sound = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 1e30)) & F.exists("vec", lambda v: v != 0)
    return vectors.select(key, F.size("vec").cast("bigint").alias("dim"), sound.alias("sound"))


def whole(x: float) -> F.Column:
    return F.lit(int(round(x))).cast("bigint")


def falling(losses: list[float]) -> bool:
    """Whether no round of a fit raised its objective."""
    return all(b <= a * (1 + 1e-9) for a, b in zip(losses, losses[1:]))


def spectrum(vectors: DataFrame, cells: DataFrame, key: str) -> DataFrame:
    """Vectors with what tells a truncated SVD of the cells (i, j, x) from other vectors of its shape.

    ``total`` is the sum of squares of all cells. ``trained``: the columns are orthogonal, their squares
    reach those of the heaviest rows, as many as there are columns (the best subspace does no worse than
    these rows), and stay below the total.
    """
    vectors = cut_lineage(vectors)
    gram = factorize._gram(vectors.select("vec"))
    squares = gram.diagonal()
    apart = abs(gram - np.diag(squares)).max() <= 1e-3 * squares.max()
    rows = cells.groupBy("i").agg(F.sum(F.col("x") * F.col("x")).alias("s"))
    total = rows.agg(F.sum("s")).first()[0]
    heaviest = sum(r.s for r in rows.orderBy(F.desc("s")).limit(len(squares)).collect())
    trained = bool(apart and 0.95 * heaviest <= squares.sum() <= total * (1 + 1e-6))
    return shape_of(vectors, key).withColumn("total", whole(total)).withColumn("trained", F.lit(trained))


@query
def m01_lsa_words(spark, folder):
    cells, words = id_cells(spark, folder)
    return spectrum(embed.lsa_words(cells, words, k=DIM), embed.log_cells(cells), "word")


@query
def m02_lsa_docs(spark, folder):
    weights = stored(cooccur.tfidf(doc_tokens(spark, folder)))
    cells = weights.select(F.col("doc_id").alias("i"), F.col("weight").alias("x"))
    return spectrum(embed.lsa_docs(weights, k=DIM), cells, "doc_id")


@query
def m03_lda(spark, folder):
    """Shares of 30 topics that sum to one in every document; ``trained``: the objective never rose, and the
    perplexity fell below that of words drawn by their frequency alone."""
    docs = cut_lineage(doc_tokens(spark, folder).select("doc_id", "tokens"))
    shares, _, losses, perplexity = topics.lda(docs, k=30, iters=8)
    counts = vocab.token_counts(docs)
    sums = counts.agg(F.sum("cnt"), F.sum(F.col("cnt") * F.ln("cnt"))).first()
    alone = math.exp(math.log(sums[0]) - sums[1] / sums[0])
    total = F.aggregate("topics", F.lit(0.0), lambda a, x: a + x)
    made = shares.select("doc_id", F.size("topics").cast("bigint").alias("k"), (F.abs(total - 1) < 1e-6).alias("whole"))
    return made.withColumn("alone", whole(alone)).withColumn("trained", F.lit(falling(losses) and perplexity < 0.9 * alone))


def languages_found(vectors: DataFrame, docs: DataFrame) -> bool:
    """Whether nearly every word lies nearest to the mean vector of the language it mostly occurs in."""
    counts = unnest(docs, ["lang"], "tokens", "word").groupBy("word", "lang").agg(F.count("*").alias("n"))
    home = counts.groupBy("word").agg(F.max_by("lang", F.struct("n", "lang")).alias("lang"), (F.max("n") / F.sum("n")).alias("share"))
    unit = F.zip_with("vec", F.array_repeat(norm("vec"), F.size("vec")), lambda v, n: v / n)  # one norm a vector
    own = cut_lineage(vectors.join(home.filter("share > 0.9"), "word").select("lang", unit.alias("vec"), F.lit(1.0).alias("w")))
    means = mean_vectors(own, ["lang"], dim=DIM).select(F.col("lang").alias("other"), F.col("vec").alias("mean"))  # a row a language
    scored = own.join(F.broadcast(means)).withColumn("s", cosine("vec", "mean"))
    best = scored.groupBy("lang", "vec").agg(F.max_by("other", "s").alias("other"))
    right = best.agg(F.avg((F.col("lang") == F.col("other")).cast("double"))).first()[0]
    return bool(right is not None and right > 0.9)


def lang_tokens(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").select("lang", tx.split_tokens("text").alias("tokens"))


@query
def m04_word2vec(spark, folder):
    trained = skipgram.skip_gram(cut_lineage(tokens(spark, folder)), DIM)
    vectors = cut_lineage(trained.words())
    good = languages_found(vectors, lang_tokens(spark, folder)) and trained.losses[-1] < trained.losses[0]
    return shape_of(vectors, "word").withColumn("trained", F.lit(good))


@query
def m05_glove(spark, folder):
    """``spread``: the weighted squares of ln x around their mean; what training leaves is a small part."""
    cells, words = id_cells(spark, folder)
    laid = factorize.glove_cells(cells)
    sums = laid.sorted.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("target")), F.sum(F.col("weight") * F.col("target") * F.col("target"))).first()
    spread_of = sums[2] - sums[1] * sums[1] / sums[0]
    fit = factorize.als_factors(laid, DIM, 15)
    made = shape_of(factorize.word_vectors(words, fit.rows, fit.cols, DIM), "word")
    return made.withColumn("spread", whole(spread_of)).withColumn("trained", F.lit(falling(fit.losses) and fit.error < 0.25 * spread_of))


@query
def m06_pmi_factors(spark, folder):
    """``pairs``: cells of the matrix that training looks at, observed or not."""
    cells, words = id_cells(spark, folder, window=5)
    fit = swivel.swivel_factors(cut_lineage(cooccur.pmi(cells)), DIM, 6)
    made = shape_of(swivel.word_vectors(words, fit.rows, fit.cols, DIM), "word")
    n = fit.rows.count()
    return made.withColumn("pairs", whole(n * n)).withColumn("trained", F.lit(falling(fit.losses) and fit.losses[-1] < 0.5 * fit.losses[0]))


@query
def m07_char_ngrams(spark, folder):
    words = vocab.token_counts(tokens(spark, folder)).filter("cnt >= 5")
    grams = skipgram.char_ngrams(words)
    return grams.groupBy("ngram").agg(F.sum("cnt").alias("cnt"), F.count("*").alias("n_words"))


@query
def m07_subword_vectors(spark, folder):
    """Means of given word vectors over n-grams, and words made of them again."""
    corpus = doc_tokens(spark, folder)
    counts = vocab.token_counts(corpus)
    grams = embed.subword_vectors(word_vectors(spark, folder), counts)
    composed = embed.compose_words(counts, cut_lineage(grams))
    return composed.select("word", numbers("vec").alias("vec"))


@query
def m07_fasttext(spark, folder):
    """Words and n-grams trained together; ``trained`` looks at the words seen too rarely for training, whose
    vectors come from n-grams alone."""
    corpus = cut_lineage(tokens(spark, folder))
    trained = skipgram.skip_gram(corpus, DIM, subwords=(3, 6), epochs=2)
    vectors = cut_lineage(skipgram.composed(vocab.token_counts(corpus), trained))
    rare = cut_lineage(vectors.join(trained.vocab, "word", "left_anti"))
    good = languages_found(rare, lang_tokens(spark, folder))
    return shape_of(vectors.join(trained.vocab, "word", "left_semi"), "word").withColumn("trained", F.lit(good))


@query
def m08_jamo_subwords(spark, folder):
    jamo = hangul_lines(spark, folder).select(tx.split_tokens(to_jamo("line")).alias("tokens"))
    counts = vocab.token_counts(jamo).filter("cnt >= 5")
    vectors = counts.select("word", random_vector(F.col("word"), DIM).alias("vec"))
    grams = embed.subword_vectors(vectors, counts)
    return grams.select("ngram", numbers("vec").alias("vec"))


@query
def m08_jamo_fasttext(spark, folder):
    """The same training on words spelled in letters."""
    jamo = cut_lineage(hangul_lines(spark, folder).select("doc_id", "line_no", tx.split_tokens(to_jamo("line")).alias("tokens")))
    trained = skipgram.skip_gram(jamo, DIM, subwords=(3, 6), epochs=2)
    made = shape_of(skipgram.composed(trained.vocab, trained), "word")
    return made.withColumn("trained", F.lit(trained.losses[-1] < trained.losses[0]))


@query
def m09_tag_vectors(spark, folder):
    tagged = embed.tag_vectors(doc_tokens(spark, folder), word_vectors(spark, folder), "source")
    return tagged.select("source", numbers("vec").alias("vec"))


@query
def m09_paragraph_vectors(spark, folder):
    """A vector for every language, fitted to its words; each scores its own words above the others'."""
    corpus = cut_lineage(tokens(spark, folder))
    contexts = cut_lineage(skipgram.skip_gram(corpus, DIM, epochs=2).contexts())
    docs = lang_tokens(spark, folder)
    tags, losses = paragraph.paragraph_vectors(docs, contexts, "lang")
    tags = cut_lineage(tags)
    counts = unnest(docs, ["lang"], "tokens", "word").groupBy("lang", "word").agg(F.count("*").alias("n")).join(contexts, "word")
    scored = counts.join(F.broadcast(tags.select(F.col("lang").alias("tag"), F.col("vec").alias("d")))).withColumn("s", dot("vec", "d"))  # a row a language
    means = scored.groupBy("tag", "lang").agg((F.sum(F.col("n") * F.col("s")) / F.sum("n")).alias("mean"))
    best = means.groupBy("tag").agg(F.max_by("lang", "mean").alias("lang"))
    good = falling(losses) and best.filter("tag <> lang").count() == 0
    return shape_of(tags, "lang").withColumn("trained", F.lit(good))


# ---------------------------------------------------------------- sentence vectors


@query
def v01_sentence_vectors(spark, folder):
    means = sentvec.sentence_vectors(doc_tokens(spark, folder), word_vectors(spark, folder), keep=["doc_id"])
    return means.select("doc_id", numbers("vec").alias("vec"))


@query
def v02_weighted_vectors(spark, folder):
    corpus = doc_tokens(spark, folder)
    weights = sentvec.sif_weights(embed.word_probabilities(corpus))
    means = sentvec.sentence_vectors(corpus, word_vectors(spark, folder), cut_lineage(weights), keep=["doc_id"])
    return means.select("doc_id", numbers("vec").alias("vec"))


def split_embeddings(spark, folder):
    marked = rows.with_split(table(spark, folder, "embeddings"), "vec_id")
    return marked.filter("split = 'train'"), marked.filter("split = 'test'")


@query
def v03_nearest_label(spark, folder):
    found = sentvec.nearest_label(*split_embeddings(spark, folder))
    return found.select(
        "vec_id", "nearest", rounded("cosine").alias("cosine"), F.col("label").cast("bigint").alias("label"), F.col("predicted").cast("bigint").alias("predicted")
    )


@query
def v03_approximate(spark, folder):
    """Nearest rows by lists; ``enough``: nine of ten rows are the exact ones."""
    train, test = split_embeddings(spark, folder)
    found = sentvec.nearest_label_approx(train, test).select("vec_id", F.col("nearest").alias("other"))
    exact = sentvec.nearest_label(train, test).join(found, "vec_id", "left")
    told = exact.agg(F.count("*").alias("n"), F.avg(F.coalesce(F.col("nearest") == F.col("other"), F.lit(False)).cast("double")).alias("recall"))
    return told.select("n", (F.col("recall") >= 0.9).alias("enough"))


@query
def v04_confusion(spark, folder):
    counts = sentvec.confusion(sentvec.nearest_label(*split_embeddings(spark, folder)))
    return counts.select(F.col("label").cast("bigint").alias("label"), F.col("predicted").cast("bigint").alias("predicted"), "cnt")


@query
def v04_accuracy(spark, folder):
    found = sentvec.evaluate(sentvec.nearest_label(*split_embeddings(spark, folder)))
    return found.select("n", rounded("accuracy").alias("accuracy"))


@query
def v05_linear_probe(spark, folder):
    labels = table(spark, folder, "labels")
    means = sentvec.sentence_vectors(doc_tokens(spark, folder), word_vectors(spark, folder), keep=["doc_id"])
    data = cut_lineage(rows.with_split(means.join(labels, "doc_id")).select("doc_id", "vec", F.col("quality").alias("label"), "split"))
    scored, _ = sentvec.linear_probe(data.filter("split = 'train'"), data.filter("split = 'test'"))
    return scored.select("doc_id", "label", "predicted")


@query
def v05_probe_fit(spark, folder):
    """A probe for the labels of the supplied vectors: rows told apart, the objective of its rounds falling, and
    at its end no slope left."""
    train, _ = split_embeddings(spark, folder)
    probe = sentvec.fit_probe(train, "embedding")
    scored = sentvec.apply_probe(train, probe, "embedding")
    told = scored.groupBy(F.col("label").cast("bigint").alias("label")).agg(F.count("*").alias("n"))
    return told.withColumn("trained", F.lit(falling(probe.losses) and probe.losses[-1] < probe.losses[0]))


@query
def v06_split(spark, folder):
    return rows.with_split(documents(spark, folder)).select("doc_id", "split")


# ---------------------------------------------------------------- sets


@query
def u01_merge(spark, folder):
    texts = {
        "documents": documents(spark, folder).select(F.col("doc_id").alias("k1"), F.lit(0).cast("bigint").alias("k2"), "text"),
        "conversations": table(spark, folder, "conversations").select(F.col("conv_id").alias("k1"), F.col("turn").alias("k2"), "text"),
        "benchmark": table(spark, folder, "benchmark").select(F.col("item_id").alias("k1"), F.lit(0).cast("bigint").alias("k2"), "text"),
    }
    merged = sets.merge_corpora(**texts)
    return merged.select(F.col("source_rank").cast("bigint").alias("source_rank"), "source", "k1", "k2", joined(tx.split_tokens("text")).alias("text"))


# ---------------------------------------------------------------- training records


def framed(spark, folder):
    return pretrain.frame_documents(documents(spark, folder))


@query
def p01_framing(spark, folder):
    flat = unnest(framed(spark, folder), ["doc_id"], F.arrays_zip("tokens", "sents"), "t", "pos")
    return flat.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("t.tokens").alias("token"), F.col("t.sents").alias("sent_no"))


@query
def p02_sentence_segments(spark, folder):
    return pretrain.sentence_segments(framed(spark, folder))


@query
def p02_turn_segments(spark, folder):
    turns = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.size(tx.split_tokens("text")).cast("bigint").alias("n_tokens")
    )
    return pretrain.segment_rows(turns, ["conv_id"], ["turn"])


@query
def p02_packed(spark, folder):
    packed = pretrain.pack_segments(framed(spark, folder))
    return packed.select("doc_id", "seg", joined("tokens").alias("tokens"))


@query
def p03_sentence_pairs(spark, folder):
    pairs = pretrain.nsp_pairs(framed(spark, folder))
    return pairs.select("doc_id", "seg", joined("a").alias("a"), joined("b").alias("b"), F.col("is_random_next").cast("int").alias("is_random_next"))


@query
def p03_own_tokens(spark, folder):
    """Tokens of every document that its own records hold: each one once."""
    own = F.size("a") + F.when(F.col("is_random_next"), 0).otherwise(F.size("b"))
    return pretrain.nsp_pairs(framed(spark, folder)).groupBy("doc_id").agg(F.sum(own).alias("n_tokens"))


def masked_records(spark, folder):
    records = pretrain.duplicate(pretrain.with_markers(pretrain.nsp_pairs(framed(spark, folder))), 5)
    words = vocab.word_ids(vocab.token_counts(framed(spark, folder)))
    return pretrain.mlm_masks(records, vocab=cut_lineage(words.select("id", F.col("word").alias("token"))))


@query
def p04_masks(spark, folder):
    """Masks over the packed segments of every document, one copy."""
    records = pretrain.pack_segments(framed(spark, folder)).withColumn("copy", F.lit(1))
    made = pretrain.mlm_masks(records)
    return made.select(
        "doc_id", "seg", joined("tokens").alias("tokens"), F.array_join(F.col("masked_positions").cast("array<string>"), " ").alias("positions"), joined("masked_labels").alias("labels")
    )


@query
def p05_copies(spark, folder):
    """Positions masked in each of the five copies."""
    records = pretrain.duplicate(pretrain.pack_segments(framed(spark, folder)), 5)
    made = pretrain.mlm_masks(records)
    return made.select(
        "doc_id", "seg", F.col("copy").cast("bigint").alias("copy"), F.array_join(F.col("masked_positions").cast("array<string>"), " ").alias("positions")
    )


@query
def p05_training_records(spark, folder):
    """The whole record job: pairs, markers, five copies, masks with random words."""
    listed = lambda c: F.array_join(F.col(c).cast("array<string>"), " ").alias(c.removeprefix("masked_"))
    arrays = [listed(c) for c in ("tokens", "segment_ids", "masked_positions", "masked_labels")]
    return masked_records(spark, folder).select(
        "doc_id", "seg", F.col("copy").cast("bigint").alias("copy"), *arrays, F.col("is_random_next").cast("int").alias("is_random_next")
    )


@query
def p06_windows(spark, folder):
    made = pretrain.xlnet_windows(framed(spark, folder))
    return made.select(
        "doc_id", "direction", F.col("win").cast("bigint").alias("win"), F.col("pass").cast("bigint").alias("pass"), F.md5(joined("tokens")).alias("tokens"), F.size("tokens").cast("bigint").alias("n"), "order_key"
    )


@query
def p07_span_masks(spark, folder):
    windows = pretrain.xlnet_windows(framed(spark, folder))
    made = pretrain.span_masks(windows)
    return made.select(
        "doc_id", "direction", F.col("win").cast("bigint").alias("win"), F.col("pass").cast("bigint").alias("pass"), F.array_join(F.col("masked_positions").cast("array<string>"), " ").alias("positions")
    )
