"""Run a job from the command line or `spark-submit`: folder of texts in, lines out.

    python -m lexigrid wordcount TEXTS OUT --stopwords FILE --top 50
    python -m lexigrid pairs     TEXTS OUT --top-words FILE -d 2
    python -m lexigrid stripes   TEXTS OUT --top-words FILE -d 2 --loose
    python -m lexigrid df        TEXTS OUT --stopwords FILE --top 100
    python -m lexigrid tfidf     TEXTS OUT --dictionary FILE
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from lexigrid.functions.words import CASE_MODES
from lexigrid.operators import cooccurrence, indexing, stripes, wordcount
from lexigrid.session import build_session
from lexigrid.sinks import render_pairs, render_ranked, render_scores, render_stripes, render_tsv, write_lines
from lexigrid.sources import as_sequence, read_df_dictionary, read_stopwords, read_text_corpus, read_top_words


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="lexigrid", description="Corpus analytics on Spark")
    jobs = main.add_subparsers(dest="job", required=True)

    def job(name: str, about: str) -> argparse.ArgumentParser:
        one = jobs.add_parser(name, help=about)
        one.add_argument("texts", help="folder of text files, one document each")
        one.add_argument("out", help="folder to write; must not exist")
        return one

    count = job("wordcount", "how often each word occurs")
    count.add_argument("--stopwords")
    count.add_argument("--case-mode", choices=CASE_MODES, default="insensitive")
    count.add_argument("--top", type=int, help="only the most frequent words")

    for name in ("pairs", "stripes"):
        matrix = job(name, f"co-occurrence of listed words as {name}")
        matrix.add_argument("--top-words", required=True)
        matrix.add_argument("-d", "--distance", type=int, default=1)
        matrix.add_argument("--by-line", action="store_true", help="add up every line first")
        if name == "stripes":
            matrix.add_argument("--loose", action="store_true", help="neighbours need only be listed")

    frequency = job("df", "in how many documents each stem occurs")
    frequency.add_argument("--stopwords")
    frequency.add_argument("--top", type=int, help="only the terms of highest frequency")

    scores = job("tfidf", "TF-IDF score of dictionary terms per document")
    scores.add_argument("--dictionary", required=True)
    return main


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    rendered, single_file = render(spark, args)
    write_lines(rendered, args.out, single_file)


def render(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, bool]:
    """Lines of the result, and whether it is of a known small size."""
    texts = read_text_corpus(spark, args.texts)
    if args.job in ("wordcount", "df"):
        stop = read_stopwords(spark, args.stopwords) if args.stopwords else None
    if args.job == "wordcount":
        counts = wordcount.word_counts(texts, stop, args.case_mode)
        if args.top:
            return render_ranked(wordcount.top_words(counts, args.top), "word", "n"), True
        return render_tsv(counts, "word", "n"), False
    if args.job == "pairs":
        top = read_top_words(spark, args.top_words)
        if args.by_line:
            return render_pairs(
                cooccurrence.roll_up_pairs(cooccurrence.pair_counts_by_line(texts, as_sequence(top), args.distance))
            ), False
        return render_pairs(cooccurrence.pair_counts(texts, top, args.distance)), False
    if args.job == "stripes":
        top = read_top_words(spark, args.top_words)
        if args.by_line:
            by_line = stripes.stripes_by_line(texts, as_sequence(top), args.distance, checked=not args.loose)
            return render_stripes(stripes.merge_stripes(by_line)), False
        return render_stripes(stripes.stripes(texts, top, args.distance, checked=not args.loose)), False
    if args.job == "df":
        frequencies = indexing.document_frequency(texts, stop)
        if args.top:
            return render_ranked(indexing.top_terms(frequencies, args.top), "term", "df"), True
        return render_tsv(frequencies, "term", "df"), False
    dictionary = read_df_dictionary(spark, args.dictionary)
    return render_scores(indexing.tf_idf(indexing.term_frequency(texts, dictionary))), False


if __name__ == "__main__":
    session = build_session()
    run(session)
    session.stop()
