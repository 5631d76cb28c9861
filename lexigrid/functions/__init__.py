from lexigrid.functions.porter import stem_word, stem_words
from lexigrid.functions.words import (
    CASE_MODES,
    is_countable,
    is_countable_token,
    java_trim,
    line_array,
    words,
)

__all__ = [
    "CASE_MODES",
    "is_countable",
    "is_countable_token",
    "java_trim",
    "line_array",
    "stem_word",
    "stem_words",
    "words",
]
