"""End-to-end jobs from paths to paths: each stage reads and writes tables or line corpora.

Line corpora are folders of text files; models, vocabularies and vectors between stages are Parquet
tables. A labelled corpus holds ``text␞label`` lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import unnest
from ..functions.hangul import to_jamo
from ..functions.vectors import random_vector
from ..operators import cooccur, embed, factorize, lattice, order, pairmerge, paragraph, pretrain, rows, sentences, sentvec, sets, skipgram, spacing, subword, tokenizers, unigram, vocab, wordscore
from ..operators import topics as topic_model
from ..operators.swivel import pmi_factorize
from ..session import cut_lineage
from ..sources import corpora, sinks

KEYS = ("file", "line_no")
CORPUS_KEYS = ("source_rank", *KEYS)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return corpora.read_lines(spark, path)


def _corpus(spark: SparkSession, *paths: str) -> DataFrame:
    """Space-separated token lines of one or more corpora, in order."""
    merged = sets.merge_corpora(**{f"c{i}": _lines(spark, p) for i, p in enumerate(paths)})
    return merged.withColumn("tokens", tx.split_tokens("line"))


# ---------------------------------------------------------------- raw corpora to lines


def process_wiki(spark, input: str, output: str) -> None:
    pages = corpora.read_wiki_xml(spark, input)
    pages.filter("text <> ''").select("text").write.mode("overwrite").text(output)


def process_ratings(spark, input: str, output: str, with_label: bool = False) -> None:
    rated = corpora.read_ratings(spark, input, with_label)
    rated = rows.format_labelled(rated) if with_label else rated
    rated.select("line").write.mode("overwrite").text(output)


def process_qa(spark, inputs: list[str], output: str) -> None:
    corpora.read_qa_json(spark, inputs).select("line").write.mode("overwrite").text(output)


def process_reviews(spark, input: str, output: str) -> None:
    corpora.review_lines(corpora.read_review_json(spark, input)).write.mode("overwrite").text(output)


# ---------------------------------------------------------------- lines to lines


def process_documents(spark, input: str, output: str) -> None:
    """Lines to sentence lines; abbreviations are learned from the file; blank lines, which part documents, stay."""
    lines = _keyed(spark, input).select("doc_id", "line")
    found = sentences.to_sentences(cut_lineage(lines), text="line")
    joined = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sent_no", "sentence"))).alias("rows"))
    whole = lines.join(joined, "doc_id", "left").select("doc_id", F.coalesce(F.array_join("rows.sentence", "\n"), F.lit("")).alias("line"))
    sinks.write_lines(whole, output, ["doc_id"])


def lexicon_tokenize(spark, input: str, lexicon: str, output: str, user: str | None = None, pos: bool = False) -> None:
    """Dictionary tokens of every line, with the user's words on top; ``pos`` writes morph/tag."""
    words = corpora.read_lexicon(spark, lexicon)
    if user:
        words = tokenizers.merge_lexicon(words, corpora.read_lexicon(spark, user))
    lines = _lines(spark, input).withColumn("tokens", tx.split_tokens(tx.strip_line("line")))
    tagged = tokenizers.lexicon_tokenize(lines, cut_lineage(words), line_keys=KEYS)
    part = lambda t: F.concat_ws("/", t["morph"], t["tag"]) if pos else t["morph"]
    sinks.write_lines(tagged.withColumn("tokens", F.transform("tagged", part)), output, KEYS, "tokens")


def morph_costs(spark, input: str, output: str) -> None:
    """Costs of words and of connections of tags from lines of ``morph/TAG``, as two tables; a line's space-separated
    tokens are chains of morphs joined by ``+``."""
    chains = _lines(spark, input).select(F.transform(tx.split_tokens(tx.strip_line("line")), lambda t: F.split(t, r"\+(?=[^+])")).alias("chains"))
    pair = lambda m: F.struct(F.regexp_extract(m, "^(.*)/[^/]*$", 1).alias("morph"), F.substring_index(m, "/", -1).alias("tag"))
    each = unnest(chains, [], F.transform("chains", lambda c: F.transform(c, pair)), "pieces")
    words, connections = lattice.estimate_costs(each)
    sinks.save_table(words, output + "/words")
    sinks.save_table(connections, output + "/connections")


def morph_tokenize(spark, input: str, costs: str, output: str, pos: bool = False) -> None:
    """Least-cost morphs of every line under the tables ``words`` and ``connections`` of the folder ``costs``."""
    lines = _lines(spark, input).withColumn("tokens", tx.split_tokens(tx.strip_line("line")))
    tagged = lattice.lattice_tokenize(lines, sinks.load_table(spark, costs + "/words"), sinks.load_table(spark, costs + "/connections"), line_keys=KEYS)
    sinks.write_lines(tagged.withColumn("tokens", rows.format_pos("tagged", pos)), output, KEYS, "tokens")


def tokenize(spark, input: str, output: str, tokenizer: str) -> None:
    sinks.write_lines(tokenizers.tokenize(_lines(spark, input), tokenizer), output, KEYS, "tokens")


def jamo(spark, input: str, output: str) -> None:
    lines = _lines(spark, input)
    sinks.write_lines(lines.withColumn("line", to_jamo(tx.strip_line("line"))), output, KEYS)


def merge(spark, inputs: list[str], output: str) -> None:
    merged = sets.merge_corpora(**{f"c{i}": _lines(spark, p) for i, p in enumerate(inputs)})
    sinks.write_lines(merged, output, ["source_rank", *KEYS])


def train_space(spark, input: str, model: str) -> None:
    lines = _lines(spark, input).withColumn("line", tx.strip_line("line"))
    sinks.save_table(spacing.spacing_train(lines), model)


def apply_space_correct(spark, input: str, model: str, output: str, with_label: bool = False) -> None:
    """Corrupt lines of a labelled corpus go to ``output`` + ``_corrupt``."""
    table = sinks.load_table(spark, model)
    if not with_label:
        fixed = spacing.spacing_apply(_lines(spark, input), table, line_keys=KEYS)
        sinks.write_lines(fixed, output, KEYS)
        return
    good, corrupt = corpora.read_labelled_lines(spark, input)
    fixed = spacing.spacing_apply(good, table, line_keys=KEYS)
    sinks.write_labelled_lines(fixed, output, KEYS)
    sinks.write_lines(corrupt, output + "_corrupt", KEYS)


def word_scores(spark, input: str, model: str) -> None:
    lines = _lines(spark, input).select(tx.split_tokens(tx.strip_line("line")).alias("tokens"))
    sinks.save_table(wordscore.word_scores(lines), model)


def score_tokenize(spark, input: str, model: str, output: str) -> None:
    split = tokenizers.l_tokenize_lines(_lines(spark, input), sinks.load_table(spark, model), line_keys=KEYS)
    sinks.write_lines(split, output, KEYS, "tokens")


def bert_vocab(spark, input: str, vocab_path: str, size: int = 32000) -> None:
    pieces = pairmerge.bpe_train(_lines(spark, input), size, 0.9995)
    sinks.save_table(subword.to_bert_vocab(pieces), vocab_path)


def bert_tokenize(spark, input: str, vocab_path: str, output: str) -> None:
    split = subword.wordpiece(_lines(spark, input), sinks.load_table(spark, vocab_path), line_keys=KEYS)
    sinks.write_lines(split, output, KEYS, "tokens")


def xlnet_vocab(spark, input: str, vocab_path: str, size: int = 32000) -> None:
    sinks.save_table(unigram.unigram_train(_lines(spark, input), size, 0.99995), vocab_path)


def vocab_export(spark, vocab_path: str, output: str) -> None:
    """A vocabulary table as a file of one token per line, the line being the id."""
    sinks.write_token_list(sinks.load_table(spark, vocab_path), output)


def vocab_import(spark, input: str, vocab_path: str) -> None:
    """A file of one token per line as a vocabulary table."""
    lines = order.with_ordinal(_lines(spark, input), KEYS, "id")
    sinks.save_table(lines.select("id", F.col("line").alias("token")), vocab_path)


def pieces_import(spark, input: str, vocab_path: str) -> None:
    """A file of ``piece<TAB>score`` lines as the vocabulary of the greedy tokenizer."""
    sinks.save_table(subword.to_bert_vocab(cut_lineage(corpora.read_piece_tsv(spark, input))), vocab_path)


def shards(spark, input: str, output: str, size: int) -> None:
    sinks.write_shards(order.shard_lines(_lines(spark, input), size, KEYS), output)


# ---------------------------------------------------------------- word vectors


def _vocab_and_cells(spark, input: str, window: int):
    corpus = _corpus(spark, input)
    words = cut_lineage(vocab.word_ids(vocab.token_counts(corpus).filter("cnt >= 5")))
    cells = cooccur.cooccurrence_ids(corpus, words, window, line_keys=CORPUS_KEYS)
    return words, cut_lineage(cells)


def lsa(spark, input: str, output: str, dim: int = 100) -> None:
    words, cells = _vocab_and_cells(spark, input, 15)
    sinks.save_table(embed.lsa_words(cells, words, dim), output)


def word2vec(spark, input: str, output: str, dim: int = 100) -> None:
    corpus = cut_lineage(_corpus(spark, input))
    sinks.save_table(skipgram.skip_gram(corpus, dim, line_keys=CORPUS_KEYS).words(), output)


def glove(spark, input: str, output: str, dim: int = 100) -> None:
    words, cells = _vocab_and_cells(spark, input, 15)
    sinks.save_table(factorize.glove(cells, words, dim), output)


def swivel(spark, input: str, output: str, dim: int = 100) -> None:
    words, cells = _vocab_and_cells(spark, input, 5)
    sinks.save_table(pmi_factorize(cut_lineage(cooccur.pmi(cells)), words, dim), output)


def fasttext(spark, input: str, output: str, dim: int = 100, unseen: str | None = None) -> None:
    """Word vectors trained together with those of their character n-grams; ``unseen`` names a corpus whose
    words get vectors beside them."""
    corpus = cut_lineage(_corpus(spark, input))
    trained = skipgram.skip_gram(corpus, dim, subwords=(3, 6), line_keys=CORPUS_KEYS)
    sinks.save_table(skipgram.composed(trained.vocab, trained), output)
    if unseen:
        others = vocab.token_counts(_corpus(spark, unseen)).join(trained.vocab, "word", "left_anti")
        sinks.save_table(skipgram.composed(others, trained), output + "_unseen")


def random_vectors(spark, input: str, output: str, dim: int = 100) -> None:
    words = vocab.vocab_count(_corpus(spark, input))
    vec = F.transform(random_vector(F.col("word"), dim), lambda v: v.cast("float"))
    sinks.save_table(words.select("word", vec.alias("vec")), output)


def _labelled_vectors(spark, path: str, vectors: DataFrame, weights: DataFrame | None) -> DataFrame:
    good, _ = corpora.read_labelled_lines(spark, path)
    ordered = order.with_ordinal(good, KEYS, "row").withColumn("tokens", tx.split_tokens("line"))
    means = sentvec.sentence_vectors(ordered, vectors, weights, keys=["row"])
    return cut_lineage(means.filter(F.col("vec").isNotNull()).select("row", "vec", "label"))


def cbow(spark, train: str, test: str, vectors: str, output: str, corpus: str | None = None) -> None:
    """Nearest-row labels and their accuracy; weighted by corpus frequency when ``corpus`` is given."""
    table = sinks.load_table(spark, vectors)
    weights = None
    if corpus:
        weights = sentvec.sif_weights(embed.word_probabilities(_corpus(spark, corpus)))
    sides = [_labelled_vectors(spark, path, table, weights) for path in (train, test)]
    found = cut_lineage(sentvec.nearest_label(*sides, key="row", vec="vec"))
    sinks.save_table(found, output)
    sinks.save_table(sentvec.evaluate(found), output + "_accuracy")
    sinks.save_table(sentvec.confusion(found), output + "_confusion")


def tune(spark, train: str, test: str, vectors: str, output: str) -> None:
    """Linear classifier on sentence vectors, in place of the tuned networks."""
    table = sinks.load_table(spark, vectors)
    sides = [_labelled_vectors(spark, path, table, None) for path in (train, test)]
    scored, _ = sentvec.linear_probe(*sides)
    sinks.save_table(scored.select("row", "label", "predicted"), output)
    sinks.save_table(sentvec.evaluate(scored), output + "_accuracy")


# ---------------------------------------------------------------- document vectors


def _keyed(spark, input: str) -> DataFrame:
    """Lines with one key, made of file and place: no text is sorted for a number."""
    key = F.concat_ws(":", "file", F.lpad(F.col("line_no").cast("string"), 20, "0"))
    return _lines(spark, input).select(key.alias("doc_id"), "line", tx.split_tokens("line").alias("tokens"))


def lsa_tfidf(spark, input: str, output: str, dim: int = 100) -> None:
    weights = cooccur.tfidf(_keyed(spark, input))
    sinks.save_table(embed.lsa_docs(cut_lineage(weights), dim), output)


def lda(spark, input: str, output: str, topics: int = 30) -> None:
    docs = cut_lineage(_keyed(spark, input).select("doc_id", "tokens"))
    shares, words, _, _ = topic_model.lda(docs, topics)
    sinks.save_table(shares, output)
    sinks.save_table(words, output + "_words")


def doc2vec(spark, input: str, output: str, dim: int = 100) -> None:
    """A vector per tag of ``text␞tag`` lines, fitted to the words under it."""
    good, _ = corpora.read_labelled_lines(spark, input)
    docs = cut_lineage(good.select(*KEYS, "label", tx.split_tokens("line").alias("tokens")))
    trained = skipgram.skip_gram(docs, dim, line_keys=KEYS)
    tags, _ = paragraph.paragraph_vectors(docs, trained.contexts(), "label")
    sinks.save_table(tags, output)


# ---------------------------------------------------------------- language-model data


def elmo_data(spark, inputs: list[str], output: str) -> None:
    """Shards of 100 000 lines and the vocabulary with its markers."""
    corpus = _corpus(spark, *inputs)
    sinks.write_shards(order.shard_lines(corpus, 100_000, ["source_rank", *KEYS]), output + "/shards")
    sinks.save_table(vocab.lm_vocab(corpus), output + "/vocab")


def _documents(spark, input: str, by_line: bool) -> DataFrame:
    """(doc_id, text): the lines between blank lines of a file, or each line by itself.

    Documents are numbered by the blank lines before them, whose counts are summed over ranges of
    lines, not in one task per file. A document is one row, so it must fit into a task.
    """
    if by_line:
        return _keyed(spark, input).select("doc_id", F.col("line").alias("text"))
    lines = _lines(spark, input).withColumn("blank", F.when(F.trim("line") == "", 1).otherwise(0))
    marks = order.running_total(lines, ["line_no"], "blank", "number", ["file"])
    whole = marks.filter("blank = 0").groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("rows"))
    key = F.concat_ws(":", "file", F.lpad(F.col("number").cast("string"), 20, "0"))
    return whole.select(key.alias("doc_id"), F.array_join("rows.line", "\n").alias("text"))


def bert_data(spark, input: str, vocab_path: str, output: str, by_line: bool = False) -> None:
    """Masked sentence-pair records: length 128, rate 0.15, at most 20 masks, seed 7, five copies.

    Blank lines part documents; with ``by_line`` every line is one.
    """
    pieces = sinks.load_table(spark, vocab_path)
    framed = pretrain.frame_documents(_documents(spark, input, by_line))
    words = subword.wordpiece_words(framed, pieces, "tokens", "flat", line_keys=["doc_id"], nested="pieces")
    pairs = pretrain.nsp_pairs(cut_lineage(pretrain.reframe(words.drop("flat"))), seed=7)
    records = pretrain.duplicate(pretrain.with_markers(pairs), 5)
    sinks.save_table(pretrain.mlm_masks(records, 0.15, 20, 7, vocab=pieces), output)


def xlnet_data(spark, input: str, vocab_path: str, output: str, by_line: bool = False) -> None:
    """Windows of 256 ids every 128, both directions, ten passes, up to 45 predicted tokens.

    Blank lines part documents; with ``by_line`` every line is one. A document is encoded once,
    before its windows are cut.
    """
    pieces = sinks.load_table(spark, vocab_path)
    docs = _documents(spark, input, by_line).select("doc_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("line"))
    encoded = unigram.unigram_encode(docs, pieces, line_keys=["doc_id"])
    ids = pieces.select(F.col("piece").alias("token"), "id")
    coded = tokenizers.encode_ids(encoded, ids, unknown=0, line_keys=["doc_id"])
    coded = cut_lineage(coded.select("doc_id", F.col("ids").alias("tokens")))
    windows = pretrain.xlnet_windows(coded, 256, 128, 10, True)
    sinks.save_table(pretrain.span_masks(windows, 6, 1, 45).withColumnRenamed("tokens", "ids"), output)
