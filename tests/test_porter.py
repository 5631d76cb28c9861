import pytest
from pyspark.sql import functions as F

from catalog.queries import document_texts
from lexigrid.functions import porter
from lexigrid.functions.porter import stem_word, stem_words
from lexigrid.operators.indexing import stem_dictionary
from lexigrid.operators.wordcount import positioned_words
from tests import brute

KNOWN = """
caresses:caress ponies:poni agreed:agre plastered:plaster sing:sing hopping:hop falling:fall
filing:file happy:happi sky:sky relational:relat conditional:condit digitizer:digit operator:oper
formalize:formal electrical:electr hopeful:hope revival:reviv replacement:replac adoption:adopt
effective:effect rate:rate cease:ceas controll:control roll:roll category:categori history:histori
people:peopl university:univers city:citi day:dai family:famili title:titl this:thi july:juli
became:becam feed:feed bled:bled motoring:motor conflated:conflat troubled:troubl sized:size
tanned:tan hissing:hiss fizzed:fizz gazelle:gazel apology:apolog geology:geologi runner:runner
is:is ay:ay be:be
"""


def stems(spark, words, **options):
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", stem_word("w", **options).alias("s"))
    return {r.w: r.s for r in rows.collect()}


def test_known_answers(spark):
    known = dict(pair.split(":") for pair in KNOWN.split())
    assert stems(spark, known) == known


@pytest.mark.parametrize("revised, expected", [(True, "apolog"), (False, "apologi")])
def test_the_later_revision_is_a_flag(spark, revised, expected):
    assert stems(spark, ["apology"], revised=revised) == {"apology": expected}


def test_arrays_keep_order_and_length(spark):
    row = spark.createDataFrame([(["running", "is", "", "running"],)], "ws array<string>")
    assert row.select(stem_words("ws").alias("s")).first().s == ["run", "is", "", "run"]


def test_against_the_definitions_of_the_paper(spark):
    """Letters and measures from the paper's wording, over all words of the small corpus and of a suffix grid."""
    tables = [dict(porter.parse_rules(t)) for t in (porter.STEP_2, porter.STEP_3, porter.STEP_4)]
    corpus = positioned_words(document_texts(spark, "/root/testdata/sf0.001")).where(F.length("word") > 1).select("word")
    bases = ["", "y", "by", "say", "syy", "tr", "tree", "oat", "troubl", "priv", "hop", "hopp", "fall", "fizz", "sens", "x"]
    endings = [e for t in tables for e in t] + ["s", "sses", "ies", "ss", "eed", "ed", "ing", "y", "e", "ll", "ion", "yed", "yying"]
    grid = [(b + e + more,) for b in bases for e in endings for more in ("", "s", "ed", "ly") if b + e + more]
    found = stem_dictionary(corpus.union(spark.createDataFrame(grid, "word string"))).collect()
    assert len(found) > 15000
    assert [(r.word, r.stem) for r in found if r.stem != brute.stem(r.word, tables)] == []
