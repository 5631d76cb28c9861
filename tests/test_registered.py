"""Every registered query against its SQL in DuckDB, and the plans that matter."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from catalog import oracle
from catalog import queries as registered

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark conversations labels".split()
QUERIES = registered.build()
SQL = oracle.build()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 50


def assert_same_rows(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    mine = sorted(map(tuple, found.select(columns).collect()), key=repr)
    cursor = duck.execute(SQL[name])
    assert sorted(d[0] for d in cursor.description) == columns
    theirs = sorted(map(tuple, duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()), key=repr)
    assert len(mine) > 0
    assert mine == theirs


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, duck, name):
    assert_same_rows(spark, duck, name)


@pytest.mark.parametrize("name", ["wordcount", "stripes_d2", "stripes_loose_neighbour_d2", "occurrence_stripes_d3", "tfidf_from_corpus"])
def test_same_rows_when_lists_are_too_large_to_broadcast(spark, duck, name):
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = spark.conf.get(limits[0])
    for limit in limits:
        spark.conf.set(limit, "-1")
    try:
        assert "BroadcastHashJoin" not in plan(spark, name)
        assert_same_rows(spark, duck, name)
    finally:
        spark.conf.set(limits[0], before)
        spark.conf.unset(limits[1])


def plan(spark, name):
    """Final-looking plan text without the subplans adaptive execution adds later."""
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return [line for line in text.splitlines() if "Exchange " in line and "BroadcastExchange" not in line]


@pytest.mark.parametrize("name", ["wordcount", "pairs_d4", "document_frequency"])
def test_counts_are_added_up_before_the_only_shuffle(spark, name):
    text = plan(spark, name)
    assert len(exchanges(text)) == 1
    assert text.index("Exchange hashpartitioning") < text.index("partial_count")


@pytest.mark.parametrize("name", ["document_frequency_of_lines", "document_frequency_conversations"])
def test_terms_travel_without_their_documents(spark, name):
    shuffles = exchanges(plan(spark, name))
    assert len(shuffles) == 2 and not [line for line in shuffles if "doc_id" in line and "term" in line]


@pytest.mark.parametrize("name", ["pairs_by_line_d2", "stripes_by_line_d2", "occurrence_stripes_d3", "line_distinct_terms"])
def test_work_on_single_lines_is_not_shuffled(spark, name):
    assert exchanges(plan(spark, name)) == []


@pytest.mark.parametrize("name", ["wordcount_top50", "df_top100", "cooccurrence_from_corpus_d2"])
def test_top_lists_are_not_fully_sorted(spark, name):
    text = plan(spark, name)
    assert "TakeOrderedAndProject" in text and not [line for line in text.splitlines() if "+- Sort" in line]


@pytest.mark.parametrize("name", ["stopwords_removed", "pairs_d2", "stripes_d2", "tfidf_from_corpus", "cooccurrence_from_corpus_d2"])
def test_lists_are_broadcast_by_their_known_size(spark, name):
    text = plan(spark, name)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_cross_join_or_row_limit_in_any_plan(spark, name):
    text = plan(spark, name)
    for banned in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit"):
        assert banned not in text


@pytest.mark.parametrize("name", QUERIES)
def test_no_list_is_gathered_and_no_table_dealt_out_anew(spark, name):
    text = plan(spark, name)
    assert "scalar-subquery" not in text and "collect_set" not in text and "RoundRobin" not in text


@pytest.mark.parametrize("name", ["document_frequency", "document_frequency_of_lines", "document_frequency_conversations", "tfidf_scores"])
def test_each_distinct_word_is_stemmed_once(spark, name):
    # One of the stemmer's longer suffixes, as often as in a plan that stems one word.
    def rules(query):
        return QUERIES[query](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString().count("ization")

    stemmers = 2 if name == "tfidf_scores" else 1  # one for the dictionary, one for the documents
    assert 0 < rules(name) == stemmers * rules("stem_dictionary")


def test_partial_stripes_are_shuffled_once(spark):
    assert len(exchanges(plan(spark, "doc_stripe_merged"))) == 1


def test_registered_queries_are_in_the_entry():
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<text:string>" in plan(spark, "wordcount")
