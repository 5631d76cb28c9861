from lexigrid.sources.corpus import document_id, lines_of, read_text_corpus
from lexigrid.sources.lists import (
    as_sequence,
    parse_df_dictionary,
    parse_stopwords,
    parse_top_words,
    read_df_dictionary,
    read_stopwords,
    read_top_words,
    word_list,
)
from lexigrid.sources.tables import read_table

__all__ = [
    "as_sequence",
    "document_id",
    "lines_of",
    "parse_df_dictionary",
    "parse_stopwords",
    "parse_top_words",
    "read_df_dictionary",
    "read_stopwords",
    "read_table",
    "read_text_corpus",
    "read_top_words",
    "word_list",
]
