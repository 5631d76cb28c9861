import pytest
from pyspark.sql import functions as F

from lexigrid.functions.words import is_countable, java_trim, line_array, words
from lexigrid.operators.wordcount import positioned_words, ranked, top_words, word_counts
from lexigrid.sources import word_list


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "text, lines",
    [
        ("", []),
        ("a", ["a"]),
        ("a\n", ["a"]),
        ("a\n\n", ["a", ""]),
        ("\n", [""]),
        ("a\r\nb\rc\nd", ["a", "b", "c", "d"]),
        ("a\r\n", ["a"]),
        ("a\r", ["a"]),
    ],
)
def test_lines_are_those_of_a_text_file(spark, text, lines):
    assert one(spark, line_array, text) == lines


def test_words_keep_positions_and_split_on_everything_but_a_to_z(spark):
    assert [w for w in one(spark, words, "The Quick-Brown xiv fox_2 café") if w] == [
        "the", "quick", "brown", "xiv", "fox", "caf",
    ]
    assert one(spark, words, " a mix of vii") == ["", "a", "mix", "of", "vii"]
    assert one(spark, words, "don't") == ["don", "t"]
    assert one(spark, words, "") == [""]


def test_which_words_count(spark):
    verdicts = {"fox": True, "ox": False, "vii": False, "xiv": False, "mix": True, "lxx": True, "civ": True, "a's": False, "": False}
    rows = spark.createDataFrame([(w,) for w in verdicts], "w string").select("w", is_countable(F.col("w")).alias("c"))
    assert {r.w: r.c for r in rows.collect()} == verdicts


def test_trim_takes_all_low_characters(spark):
    assert one(spark, java_trim, "\t \x01a b\x00\r\n") == "a b"


@pytest.mark.parametrize(
    "mode, expected",
    [("insensitive", {"war": 3}), ("lower_after_split", {"war": 3}), ("capitals_separate", {"war": 1})],
)
def test_case_modes(spark, lines_from, mode, expected):
    counted = word_counts(lines_from({"a": ["War war WAR"]}), case_mode=mode)
    assert {r.word: r.n for r in counted.collect()} == expected


def test_unknown_case_mode_is_refused():
    with pytest.raises(ValueError):
        words(F.lit("x"), "upper")


def test_stopwords_are_optional(spark, lines_from):
    lines = lines_from({"a": ["the fox", "The end xii"]})
    stop = word_list(spark, ["the", "a's"])
    assert {r.word: r.n for r in word_counts(lines).collect()} == {"the": 2, "fox": 1, "end": 1}
    assert {r.word: r.n for r in word_counts(lines, stop).collect()} == {"fox": 1, "end": 1}


def test_positions_count_words_that_are_later_dropped(lines_from):
    rows = positioned_words(lines_from({"a": ["-of the 1 war"]})).collect()
    assert {(r.pos, r.word) for r in rows} == {(1, "of"), (2, "the"), (3, "war")}


@pytest.mark.parametrize("ties, expected", [("ascending", ["ccc", "aaa"]), ("descending", ["ccc", "bbb"])])
def test_ties_in_top_lists(spark, ties, expected):
    counts = spark.createDataFrame([("aaa", 2), ("bbb", 2), ("ccc", 5)], "word string, n long")
    assert [r.word for r in top_words(counts, 2, ties).collect()] == expected


def test_ranked(spark):
    counts = spark.createDataFrame([("aaa", 2), ("bbb", 2), ("ccc", 5)], "word string, n long")
    assert [(r.place, r.word) for r in ranked(counts).collect()] == [(1, "ccc"), (2, "aaa"), (3, "bbb")]
