"""Every registered query: a function of a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.inputs import STOPWORDS, TOP_WORDS, TOP_WORDS_AND_NUMERAL
from lexigrid.functions.words import is_countable_token, is_roman
from lexigrid.operators import cooccurrence, indexing, stripes, wordcount
from lexigrid.plans import cooccurrence_of_corpus, scores_of_corpus
from lexigrid.sinks import render_pairs, render_scores, render_stripes, render_tsv, stripe_text
from lexigrid.sources import (
    document_id,
    lines_of,
    parse_df_dictionary,
    parse_stopwords,
    parse_top_words,
    read_table,
    word_list,
)

Query = Callable[[SparkSession, str], DataFrame]


# -- inputs -------------------------------------------------------------------


def documents(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return read_table(spark, f"{folder}/documents.parquet", "doc_id", "text", *more)


def document_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts, for jobs where a line break is a separator like any other."""
    return documents(spark, folder).withColumnRenamed("text", "line")


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines_of(documents(spark, folder))


def conversation_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as documents spread over many rows."""
    turns = read_table(spark, f"{folder}/conversations.parquet", "conv_id", "text")
    return turns.select(F.col("conv_id").alias("doc_id"), F.col("text").alias("line"))


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, f"{folder}/pages.parquet", "html").withColumnRenamed("html", "line")


def stop(spark: SparkSession) -> DataFrame:
    return word_list(spark, STOPWORDS)


def top(spark: SparkSession) -> DataFrame:
    return word_list(spark, TOP_WORDS)


# -- sources ------------------------------------------------------------------


def scan_lines(spark, folder):
    return document_lines(spark, folder)


def doc_id_from_path(spark, folder):
    extension = F.when(F.col("lang") == "en", ".txt").when(F.col("lang") == "de", ".tar.gz").otherwise("")
    path = F.concat(F.lit("/corpus/"), "source", F.lit("/"), F.col("doc_id").cast("string"), extension)
    table = read_table(spark, f"{folder}/documents.parquet", "doc_id", "source", "lang")
    return table.select("doc_id", path.alias("path"), document_id(path).alias("file_id"))


def stopwords_parse(spark, folder):
    """Every line of the corpus taken as a line of a stopword file."""
    return parse_stopwords(document_lines(spark, folder), "line")


def topwords_parse(spark, folder):
    """Word counts written as list lines in several layouts, then read back."""
    counts = wordcount.word_counts(document_texts(spark, folder))
    layout = (
        F.when(F.col("n") == 1, F.concat_ws("\t", F.initcap("word"), "n"))
        .when(F.col("n") == 2, F.concat_ws(" ", F.lit(""), "word", "n"))
        .when(F.col("n") == 3, F.upper("word"))
        .otherwise(F.concat_ws("  \t", "word", "n"))
    )
    return parse_top_words(counts.select(layout.alias("value")))


def df_dictionary_parse(spark, folder):
    """Frequencies by language written as dictionary lines, good and bad, then read back."""
    tagged = documents(spark, folder, "lang").withColumnRenamed("text", "line")
    found = wordcount.countable_words(tagged).distinct().groupBy("word", "lang").agg(F.count("*").alias("df"))
    layout = (
        F.when(F.col("lang") == "en", F.concat_ws("\t", "word", "df"))
        .when(F.col("lang") == "de", F.concat(F.lit(" "), "word", F.lit(" \t +"), "df", F.lit("\t\t")))
        .when(F.col("lang") == "fr", F.concat_ws("\t", "word", "df", F.lit("x")))
        .otherwise(F.concat_ws("\t", "word", F.concat("df", F.lit(".0"))))
    )
    return parse_df_dictionary(found.select(layout.alias("value"), "lang"), order="lang")


# -- words --------------------------------------------------------------------


def tokens(spark, folder):
    return wordcount.positioned_words(document_lines(spark, folder))


def valid_tokens(spark, folder):
    return tokens(spark, folder).where(is_countable_token(F.col("word")))


def roman_tokens_dropped(spark, folder):
    return tokens(spark, folder).where((F.length("word") > 2) & is_roman(F.col("word")))


def stopwords_removed(spark, folder):
    kept = wordcount.without_stopwords(valid_tokens(spark, folder), stop(spark))
    return kept.select("doc_id", "line_no", "pos", "word")


def topword_tokens(spark, folder):
    found = tokens(spark, folder).join(cooccurrence.listed_words(top(spark)), "word", "left_semi")
    return found.select("doc_id", "line_no", "pos", "word")


def stem_dictionary(spark, folder):
    word_rows = wordcount.positioned_words(document_texts(spark, folder))
    return indexing.stem_dictionary(word_rows.where(F.length("word") >= indexing.MIN_SCORED_LENGTH))


# -- word counts --------------------------------------------------------------


def counts(spark, folder, **options):
    return wordcount.word_counts(document_texts(spark, folder), stop(spark), **options)


def wordcount_no_stopwords(spark, folder):
    return wordcount.word_counts(document_texts(spark, folder))


def top50(spark, folder):
    return wordcount.top_words(counts(spark, folder), 50)


def wordcount_pages_top50(spark, folder):
    return wordcount.top_words(wordcount.word_counts(page_texts(spark, folder), stop(spark)), 50)


# -- pairs and stripes ----------------------------------------------------------


def pairs(distance: int) -> Query:
    return lambda spark, folder: cooccurrence.pair_counts(document_lines(spark, folder), top(spark), distance)


def pairs_by_line(spark, folder, distance=2):
    return cooccurrence.pair_counts_by_line(document_lines(spark, folder), TOP_WORDS, distance)


def rendered(stripe_rows: DataFrame) -> DataFrame:
    return stripe_rows.withColumn("stripe", stripe_text(F.col("stripe")))


def stripe_maps(distance: int) -> Query:
    return lambda spark, folder: stripes.stripes(document_lines(spark, folder), top(spark), distance)


def rendered_stripes(distance: int) -> Query:
    return lambda spark, folder: rendered(stripe_maps(distance)(spark, folder))


def occurrence_stripes_d3(spark, folder):
    return rendered(stripes.occurrence_stripes(document_lines(spark, folder), TOP_WORDS, 3))


def stripe_maps_by_line(spark, folder, distance=2):
    return stripes.stripes_by_line(document_lines(spark, folder), TOP_WORDS, distance)


def rolled_up_pairs(distance: int) -> Query:
    return lambda spark, folder: cooccurrence.roll_up_pairs(pairs_by_line(spark, folder, distance))


def rolled_up_stripes(distance: int) -> Query:
    return lambda spark, folder: rendered(stripes.merge_stripes(stripe_maps_by_line(spark, folder, distance)))


def stripes_loose_neighbour_d2(spark, folder):
    listed = word_list(spark, TOP_WORDS_AND_NUMERAL)
    return rendered(stripes.stripes(document_lines(spark, folder), listed, 2, checked=False))


# -- documents ------------------------------------------------------------------


def line_distinct_terms(spark, folder):
    found = indexing.distinct_terms(document_lines(spark, folder), STOPWORDS, stemmed=False)
    return found.withColumn("terms", F.array_join(F.array_sort("terms"), " "))


def df_of_documents(spark, folder, stemmed=True):
    """`doc_id` is the key of the table: every row is one document."""
    return indexing.document_frequency_of_rows(documents(spark, folder), STOPWORDS, stemmed)


def df_of_lines(spark, folder):
    return indexing.document_frequency(document_lines(spark, folder), stop(spark))


def df_of_conversations(spark, folder):
    return indexing.document_frequency(conversation_texts(spark, folder), stop(spark))


def dictionary(spark, folder):
    return indexing.top_terms(df_of_documents(spark, folder))


def own_dictionary(spark, folder):
    """`dictionary` and the words to look for: those of all terms that can be in it."""
    texts = documents(spark, folder)
    listed = indexing.words_of_top_terms(texts, STOPWORDS)
    return indexing.top_terms(indexing.document_frequency_of_rows(texts, STOPWORDS, listed=listed)), listed


def frequencies(spark, folder):
    given, listed = own_dictionary(spark, folder)
    return indexing.term_frequency(document_texts(spark, folder), given, listed=listed)


def doc_stripe_merged(spark, folder):
    """Encoded stripes of single lines, with broken parts added, merged by document."""
    given, listed = own_dictionary(spark, folder)
    terms = [r.term for r in given.select("term").collect()]  # 100
    partial = indexing.row_stripes(document_lines(spark, folder).select("doc_id", "line"), terms, listed=listed)
    encoded = indexing.encoded_stripes(partial)
    broken = F.concat("stripe", F.lit("|x|y:z||:|term:1.5"))
    return indexing.merge_encoded_stripes(encoded.select("doc_id", broken.alias("stripe")))


def rounded(scores: DataFrame) -> DataFrame:
    return scores.withColumn("score", F.round("score", 6))


def corpus_scores(spark, folder, stemmed=True):
    return scores_of_corpus(document_texts(spark, folder), STOPWORDS, whole_documents=True, stemmed=stemmed)


def tfidf_scores(spark, folder):
    """Documents scored with a dictionary that another collection supplies."""
    given = indexing.top_terms(df_of_conversations(spark, folder))
    return rounded(indexing.tf_idf(indexing.term_frequency(document_texts(spark, folder), given)))


def tfidf_from_stripes(spark, folder):
    """Encoded stripes of one collection's terms, scored with the dictionary of another; df 1 where it lacks a term."""
    encoded = indexing.encoded_stripes(indexing.document_stripes(frequencies(spark, folder)))
    given = indexing.top_terms(df_of_conversations(spark, folder))
    known = indexing.with_document_frequency(indexing.merge_encoded_stripes(encoded), given)
    scores = known.withColumn("score", indexing.score(F.col("tf"), F.col("df")))
    return rounded(scores.select("doc_id", "term", F.col("df").cast("long").alias("df"), "score"))


def build() -> dict[str, Query]:
    return {
        "scan_lines": scan_lines,
        "doc_id_from_path": doc_id_from_path,
        "stopwords_parse": stopwords_parse,
        "topwords_parse": topwords_parse,
        "df_dictionary_parse": df_dictionary_parse,
        "tokens": tokens,
        "valid_tokens": valid_tokens,
        "roman_tokens_dropped": roman_tokens_dropped,
        "stopwords_removed": stopwords_removed,
        "topword_tokens": topword_tokens,
        "stem_dictionary": stem_dictionary,
        "wordcount": counts,
        "wordcount_no_stopwords": wordcount_no_stopwords,
        "wordcount_case_lower_after": lambda s, d: counts(s, d, case_mode="lower_after_split"),
        "wordcount_case_strict": lambda s, d: counts(s, d, case_mode="capitals_separate"),
        "wordcount_top50": top50,
        "wordcount_top50_shell_ties": lambda s, d: wordcount.top_words(counts(s, d), 50, "descending"),
        "wordcount_top50_ranked": lambda s, d: wordcount.ranked(top50(s, d)),
        "wordcount_pages_top50": wordcount_pages_top50,
        "wordcount_tsv_lines": lambda s, d: render_tsv(counts(s, d), "word", "n").select("line"),
        **{f"pairs_d{d}": pairs(d) for d in (1, 2, 3, 4)},
        "pairs_lead_window_d2": lambda s, d: cooccurrence.pair_counts_by_window(document_lines(s, d), top(s), 2),
        "pairs_by_line_d2": pairs_by_line,
        **{f"pairs_line_rollup_d{d}": rolled_up_pairs(d) for d in (1, 2, 3, 4)},
        "pairs_rendered_d1": lambda s, d: render_pairs(pairs(1)(s, d)).select("line"),
        "cooccurrence_from_corpus_d2": lambda s, d: cooccurrence_of_corpus(
            document_lines(s, d), stop(s), k=50, distance=2
        ),
        **{f"stripes_d{d}": rendered_stripes(d) for d in (1, 2, 3, 4)},
        "stripes_rendered_d2": lambda s, d: render_stripes(stripe_maps(2)(s, d)).select("line"),
        "stripes_by_line_d2": lambda s, d: rendered(stripe_maps_by_line(s, d)),
        **{f"stripes_line_rollup_d{d}": rolled_up_stripes(d) for d in (1, 2, 3, 4)},
        "occurrence_stripes_d3": occurrence_stripes_d3,
        "stripes_loose_neighbour_d2": stripes_loose_neighbour_d2,
        "line_distinct_terms": line_distinct_terms,
        "document_frequency": df_of_documents,
        "document_frequency_of_lines": df_of_lines,
        "document_frequency_unstemmed": lambda s, d: df_of_documents(s, d, stemmed=False),
        "document_frequency_conversations": df_of_conversations,
        "df_top100": dictionary,
        "df_top100_unstemmed": lambda s, d: indexing.top_terms(df_of_documents(s, d, stemmed=False)),
        "df_tsv_lines": lambda s, d: render_tsv(df_of_documents(s, d), "term", "df").select("line"),
        "term_frequency": lambda s, d: frequencies(s, d).drop("df"),
        "doc_stripe_encoded": lambda s, d: indexing.encoded_stripes(indexing.document_stripes(frequencies(s, d))),
        "doc_stripe_merged": doc_stripe_merged,
        "tfidf_scores": tfidf_scores,
        "tfidf_from_stripes": tfidf_from_stripes,
        "tfidf_from_corpus": lambda s, d: rounded(corpus_scores(s, d)),
        "tfidf_scores_unstemmed": lambda s, d: rounded(corpus_scores(s, d, stemmed=False)),
        "tfidf_tsv_lines": lambda s, d: render_scores(corpus_scores(s, d)).select("line"),
    }
