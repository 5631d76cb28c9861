"""Jobs that feed one another, as one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lexigrid.operators.cooccurrence import pair_counts
from lexigrid.operators.indexing import (
    DICTIONARY_SIZE,
    document_frequency,
    document_frequency_of_rows,
    term_frequency,
    tf_idf,
    top_terms,
    words_of_top_terms,
)
from lexigrid.operators.wordcount import top_words, word_counts


def cooccurrence_of_corpus(
    lines: DataFrame, stopwords: DataFrame | None = None, k: int = 50, distance: int = 1, line: str = "line"
) -> DataFrame:
    """Pair counts among the corpus's own `k` most frequent words.

    Two passes over the corpus: the list has to be complete before the first
    pair can be told. The list is `k` rows and is broadcast as such.
    """
    top = top_words(word_counts(lines, stopwords, line=line), k)
    return pair_counts(lines, top, distance, line)


def scores_of_corpus(
    texts: DataFrame,
    stopwords: DataFrame | Sequence[str] | None = None,
    k: int = DICTIONARY_SIZE,
    whole_documents: bool = False,
    stemmed: bool = True,
    doc_id: str = "doc_id",
    line: str = "line",
) -> DataFrame:
    """TF-IDF of a corpus over its own `k` terms of highest document frequency.

    Set `whole_documents` where every row is one document; see
    `document_frequency_of_rows`. Its list is then a sequence, otherwise a DataFrame, and if
    terms are stemmed the words to look for are found at once, in a job of its own.
    """
    listed = words_of_top_terms(texts, stopwords, k, line) if whole_documents and stemmed else None
    if whole_documents:
        frequencies = document_frequency_of_rows(texts, stopwords, stemmed, line, listed)
    else:
        frequencies = document_frequency(texts, stopwords, stemmed, doc_id, line)
    return tf_idf(term_frequency(texts, top_terms(frequencies, k), stemmed, doc_id, line, listed))
