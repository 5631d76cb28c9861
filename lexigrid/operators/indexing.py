"""Document frequency, term frequency, per-document stripes and TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.arrays import bind, count_equal, run_slices
from lexigrid.functions.porter import stem_word, stem_words
from lexigrid.functions.words import is_countable_token, words
from lexigrid.operators.wordcount import without_stopwords
from lexigrid.sinks.text import encode_stripe

# Fixed value: the collection size in the score is this constant, whatever the
# size of the corpus.
SCORED_DOCUMENTS = 10000.0
MIN_SCORED_LENGTH = 2
DICTIONARY_SIZE = 100
# Tuned values: beyond so many terms or words to look for, every word is stemmed instead.
MOST_FAMILIES, MOST_LISTED = 5_000, 20_000
# Tuned values: the characters of a document put together in one row, and how many longer ones are told apart.
LONGEST_TOGETHER, MOST_LONG = 1_000_000, 20_000


# -- stems ------------------------------------------------------------------


def stem_dictionary(word_rows: DataFrame, column: str = "word") -> DataFrame:
    """`word, stem` for every distinct word."""
    distinct = word_rows.select(F.col(column).alias("word")).distinct()
    return distinct.select("word", stem_word("word").alias("stem"))


# -- document frequency -------------------------------------------------------


def distinct_terms(
    lines: DataFrame,
    stopwords: Sequence[str] | None = None,
    stemmed: bool = True,
    line: str = "line",
    listed: Sequence[str] | None = None,
) -> DataFrame:
    """Each row with `terms`, its distinct terms, in place of the line.

    Words have to count and be on no stopword list, before stemming and again after it. All of it
    happens inside the row, so the list is a sequence, which each task has as one hash set; each
    distinct word is stemmed once. With `listed` only the terms of these words are looked for.
    """
    others = [name for name in lines.columns if name != line]
    stop = sorted({*(stopwords or ())})

    def allowed(word: Column) -> Column:
        return is_countable_token(word) & ~word.isin(stop) if stop else is_countable_token(word)

    found = lines.select(*others, F.filter(F.array_distinct(_listed_words(line, listed)), allowed).alias("terms"))
    if stemmed:
        found = found.withColumn("terms", F.filter(F.array_distinct(stem_words("terms")), allowed))
    return found.select(*others, "terms")


def _listed_words(line: str, listed: Sequence[str] | None) -> Column:
    """The words of a line, or of these only the listed ones."""
    found = words(F.col(line))
    return found if listed is None else F.filter(found, lambda word: word.isin(sorted({*listed})))


def _document_terms(rows: DataFrame, stopwords: DataFrame | None, stemmed: bool, line: str) -> DataFrame:
    """The other columns and `term`, words of the rows that count; repeats of a word in a row only once.

    The list is joined, before stemming and again after it, so it may be of any size. Each distinct word of a row is
    paired with its stem inside the row: joins and filters above the explode can't move below it, so nothing
    computes a stem a second time.
    """
    others = [name for name in rows.columns if name != line]
    counted = F.filter(F.array_distinct(words(F.col(line))), is_countable_token)
    if not stemmed:
        found = rows.select(*others, F.explode_outer(counted).alias("term")).where(F.col("term").isNotNull())
        return without_stopwords(found, stopwords, "term")
    rows = rows.select(*others, counted.alias("_words"))
    both = F.arrays_zip(F.col("_words").alias("word"), stem_words("_words").alias("term"))
    kept = F.filter(both, lambda pair: is_countable_token(pair["term"]))
    found = rows.select(*others, F.inline_outer(kept).alias("word", "term")).where(F.col("term").isNotNull())
    return without_stopwords(without_stopwords(found, stopwords, "word"), stopwords, "term").select(*others, "term")


def _short_list(stopwords: DataFrame | None) -> list[str] | None:
    """The words of a list that is short enough for every task to hold, else None."""
    if stopwords is None:
        return []
    rows = stopwords.where(F.col("word").isNotNull()).select("word").limit(MOST_LISTED + 1).collect()
    return [row.word for row in rows] if len(rows) <= MOST_LISTED else None


def long_documents(lines: DataFrame, doc_id: str = "doc_id", line: str = "line") -> list[int] | None:
    """The hashes of the documents too long for one row; None where they are too many for a list."""
    lengths = lines.groupBy(doc_id).agg(F.sum(F.length(line) + 1).alias("_length"))
    long = lengths.where(F.col("_length") > LONGEST_TOGETHER).select(F.xxhash64(doc_id).alias("key"))
    keys = [row.key for row in long.limit(MOST_LONG + 1).collect()]
    return keys if len(keys) <= MOST_LONG else None


def document_frequency(
    lines: DataFrame,
    stopwords: DataFrame | None = None,
    stemmed: bool = True,
    doc_id: str = "doc_id",
    line: str = "line",
) -> DataFrame:
    """`term, df`: in how many documents each term occurs.

    For documents spread over many rows, in any order and place. The lines of a document are put together in one
    row, where its terms are made distinct, so lines travel and not their (document, term) pairs. Longer documents,
    which a job of its own finds, stay as they are: their (document, term) pairs are made distinct in each task, then
    once more by key: the keys are many and of equal weight even if one document or one term is everywhere. So does
    everything where the long documents or the words of the list are too many to be listed.
    """
    rows = lines.select(doc_id, line)
    listed = _short_list(stopwords)
    long = None if listed is None else long_documents(rows, doc_id, line)

    def by_pairs(rows: DataFrame) -> DataFrame:
        terms = _document_terms(rows, stopwords, stemmed, line)
        return terms.distinct().groupBy("term").agg(F.count("*").alias("df"))

    def together(rows: DataFrame) -> DataFrame:
        texts = rows.groupBy(doc_id).agg(F.listagg(line, F.lit("\n")).alias(line))
        return document_frequency_of_rows(texts, listed, stemmed, line)

    if long is None:
        return by_pairs(rows)
    if not long:
        return together(rows)
    # Documents that share the hash of a long one are taken for long too, which changes no count.
    is_long = F.xxhash64(doc_id).isin(long)
    both = together(rows.where(~is_long)).unionByName(by_pairs(rows.where(is_long)))
    return both.groupBy("term").agg(F.sum("df").alias("df"))


def document_frequency_of_rows(
    texts: DataFrame,
    stopwords: Sequence[str] | None = None,
    stemmed: bool = True,
    text: str = "text",
    listed: Sequence[str] | None = None,
) -> DataFrame:
    """`document_frequency` where every row is one whole document.

    A row's terms are distinct already, so they are counted at once and only
    (term, partial count) rows are shuffled, never (document, term). With `listed`
    only these words are looked at.
    """
    terms = distinct_terms(texts.select(text), stopwords, stemmed, text, listed)
    occurrences = terms.select(F.explode_outer("terms").alias("term")).where(F.col("term").isNotNull())
    return occurrences.groupBy("term").agg(F.count("*").alias("df"))


def top_terms(frequencies: DataFrame, k: int = DICTIONARY_SIZE) -> DataFrame:
    """The `k` terms of highest document frequency; equal ones in term order."""
    return frequencies.orderBy(F.desc("df"), F.asc("term")).limit(k)


def words_of_top_terms(
    texts: DataFrame, stopwords: Sequence[str] | None = None, k: int = DICTIONARY_SIZE, text: str = "text"
) -> list[str] | None:
    """Every word whose stem can be among the `k` of highest document frequency; every row is one document.

    A stem is in as many documents as its most frequent word at least, and in as many as its words together at most.
    So stems whose upper bound is below the k-th lower bound are out, and only each distinct word of the corpus is
    stemmed, not each of a document. None where the words are too many for a list: then all words are to be looked at.
    """
    stop = sorted({*(stopwords or ())})

    def allowed(word: Column) -> Column:
        return is_countable_token(word) & ~word.isin(stop) if stop else is_countable_token(word)

    found = texts.select(F.explode_outer(F.array_distinct(words(F.col(text)))).alias("word"))
    counts = found.where(F.length("word") >= MIN_SCORED_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    # Filters can't move below the generator, so a stem is computed once for each distinct word.
    stems = counts.select("word", "n", F.explode_outer(stem_words("array(word)")).alias("term"))
    counted = F.when(allowed(F.col("word")), F.col("n"))
    families = stems.where(allowed(F.col("term"))).groupBy("term").agg(
        F.max(counted).alias("least"), F.sum(counted).alias("most"), F.collect_list("word").alias("words")
    ).where(F.col("most").isNotNull())
    rows = families.orderBy(F.desc("most")).limit(MOST_FAMILIES + 1).collect()
    least = min(sorted((row.least for row in rows), reverse=True)[:k], default=0)
    if len(rows) > MOST_FAMILIES and rows[-1].most >= least:
        return None
    listed = sorted({word for row in rows if row.most >= least for word in row.words})
    return listed if len(listed) <= MOST_LISTED else None


# -- term frequency and scores ----------------------------------------------


def scored_terms(
    lines: DataFrame,
    stemmed: bool = True,
    doc_id: str = "doc_id",
    line: str = "line",
    listed: Sequence[str] | None = None,
) -> DataFrame:
    """`doc_id, term, n` per row and distinct word, by the looser rule for scoring.

    Words of two letters or more; no stopword list, no Roman rule. Repeats of a
    word in a row are counted first, so each is stemmed once. With `listed` only
    these words are counted.
    """
    counted = F.filter(_listed_words(line, listed), lambda word: F.length(word) >= MIN_SCORED_LENGTH)
    rows = lines.select(F.col(doc_id).alias("doc_id"), count_equal(counted).alias("_runs"))
    terms = stem_words("_runs.item") if stemmed else F.col("_runs.item")
    zipped = rows.select("doc_id", F.arrays_zip(terms.alias("term"), F.col("_runs.n").alias("n")).alias("_terms"))
    return zipped.select("doc_id", F.inline_outer("_terms").alias("term", "n")).where(F.col("term").isNotNull())


def term_frequency(
    lines: DataFrame,
    dictionary: DataFrame,
    stemmed: bool = True,
    doc_id: str = "doc_id",
    line: str = "line",
    listed: Sequence[str] | None = None,
) -> DataFrame:
    """`doc_id, term, tf, df` for the terms of a dictionary (`term, df`).

    Words outside the dictionary are dropped before anything is shuffled, and
    each task adds up its part of a document first. `listed`, if given, holds every
    word of the lines that has a term of the dictionary, such as `words_of_top_terms`;
    others are dropped before they are counted and stemmed.
    """
    found = scored_terms(lines, stemmed, doc_id, line, listed).join(dictionary.select("term", "df"), "term")
    return found.groupBy("doc_id", "term", "df").agg(F.sum("n").alias("tf")).select("doc_id", "term", "tf", "df")


def score(tf: Column, df: Column, documents: float = SCORED_DOCUMENTS) -> Column:
    """`tf * ln(documents / df + 1)`."""
    return tf * F.ln(F.lit(documents) / df + F.lit(1.0))


def tf_idf(frequencies: DataFrame, documents: float = SCORED_DOCUMENTS) -> DataFrame:
    """`doc_id, term, score`; a document without a dictionary term has no row."""
    return frequencies.select("doc_id", "term", score(F.col("tf"), F.col("df"), documents).alias("score"))


# -- per-document stripes -----------------------------------------------------


def document_stripes(frequencies: DataFrame) -> DataFrame:
    """`doc_id, stripe`: one map of term counts per document, at most a dictionary long."""
    entries = F.array_sort(F.collect_list(F.struct("term", "tf")))
    return frequencies.groupBy("doc_id").agg(F.map_from_entries(entries).alias("stripe"))


def row_stripes(
    lines: DataFrame,
    terms: Sequence[str],
    stemmed: bool = True,
    line: str = "line",
    listed: Sequence[str] | None = None,
) -> DataFrame:
    """The stripe of every single row: the other columns and `stripe`, empty where no term occurs. No shuffle.

    The terms are a sequence, which each task has as one hash set; words are counted, then stemmed, in the row.
    `listed` is as for `term_frequency`.
    """
    others = [name for name in lines.columns if name != line]
    wanted = sorted({*terms})
    counted = F.filter(_listed_words(line, listed), lambda word: F.length(word) >= MIN_SCORED_LENGTH)
    rows = lines.select(*others, count_equal(counted).alias("_runs"))
    stems = stem_words("_runs.item") if stemmed else F.col("_runs.item")
    found = F.filter(F.arrays_zip(stems.alias("term"), F.col("_runs.n").alias("n")), lambda x: x["term"].isin(wanted))

    def entry(run: Column) -> Column:
        total = F.aggregate(run, F.lit(0).cast("long"), lambda n, x: n + x["n"])
        return F.struct(F.get(run, F.lit(0))["term"].alias("term"), total.alias("tf"))

    entries = bind(F.array_sort(found), lambda x: F.transform(run_slices(x, "term"), entry))
    return rows.select(*others, F.map_from_entries(entries).alias("stripe"))


def encoded_stripes(stripes: DataFrame) -> DataFrame:
    """`doc_id, stripe` with the stripe as `term:count|term:count`."""
    return stripes.select("doc_id", encode_stripe(F.col("stripe")).alias("stripe"))


def merge_encoded_stripes(encoded: DataFrame) -> DataFrame:
    """`doc_id, term, tf`: decode partial stripes of documents and add them up.

    Parts without a colon or with a count that is no 32-bit integer are skipped.
    """
    parts = encoded.select("doc_id", F.explode_outer(F.split("stripe", r"\|")).alias("part"))
    colon = F.instr("part", ":")
    count = F.substring(F.col("part"), colon + 1, F.length("part"))
    return (
        parts.where(colon > 0)
        .select(
            "doc_id",
            F.substring(F.col("part"), F.lit(1), colon - 1).alias("term"),
            F.when(count.rlike("^[+-]?[0-9]+$"), count.try_cast("int")).alias("count"),
        )
        .where(F.col("count").isNotNull())
        .groupBy("doc_id", "term")
        .agg(F.sum("count").alias("tf"))
    )


def with_document_frequency(frequencies: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add `df` to `doc_id, term, tf` that came from elsewhere; 1 for unknown terms."""
    joined = frequencies.join(dictionary.select("term", "df"), "term", "left")
    return joined.select("doc_id", "term", "tf", F.coalesce("df", F.lit(1)).alias("df"))
