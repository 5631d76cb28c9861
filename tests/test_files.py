"""Text files in and out."""

import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lexigrid.operators.cooccurrence import pair_counts
from lexigrid.operators.stripes import stripes
from lexigrid.sinks import render_pairs, render_scores, render_stripes, render_tsv, stripe_text, write_lines
from lexigrid.sources import (
    document_id,
    read_df_dictionary,
    read_stopwords,
    read_table,
    read_text_corpus,
    read_top_words,
    word_list,
)


def test_a_folder_of_texts(spark, tmp_path):
    files = {"107301.txt": "one\ntwo\n", "x.tar.gz.txt": "a\r\nb\rc", "README": "no end", "a b+c%20.txt": "odd", "empty.txt": ""}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content.encode())
    found = {}
    for r in read_text_corpus(spark, str(tmp_path)).collect():
        found.setdefault(r.doc_id, set()).add(r.line)
    assert found == {"107301": {"one", "two"}, "x.tar.gz": {"a", "b", "c"}, "README": {"no end"}, "a b+c%20": {"odd"}}


def test_document_ids(spark):
    paths = spark.createDataFrame([("/a/107301.txt",), ("x.tar.gz",), ("/b.c/README",)], "p string")
    assert [r[0] for r in paths.select(document_id(F.col("p"))).collect()] == ["107301", "x.tar", "README"]


def test_list_files(spark, tmp_path):
    (tmp_path / "stop").write_text("The  \n\n and\t\nthe\n")
    assert {r.word for r in read_stopwords(spark, str(tmp_path / "stop")).collect()} == {"the", "and"}
    (tmp_path / "top").write_text("Apos\t273057\nquot 5\napos\n\n leading 3\n")
    assert {r.word for r in read_top_words(spark, str(tmp_path / "top")).collect()} == {"apos", "quot"}


def test_dictionary_file(spark, tmp_path):
    lines = ["run\t2", "bad", "x\ty", "run\t3\t\t", "a\tb\tc", " pad \t +7 ", "big\t99999999999", "dec\t1.0", "a\t1\tb", "last\t-4"]
    (tmp_path / "df").write_text("\n".join(lines))
    found = {r.term: r.df for r in read_df_dictionary(spark, str(tmp_path / "df")).collect()}
    assert found == {"run": 3, "pad": 7, "last": -4}


def test_the_last_of_many_repeated_terms_wins_in_a_split_file(spark, tmp_path):
    (tmp_path / "df").write_text("".join(f"t{i % 5}\t{i}\n" for i in range(5000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = {r.term: r.df for r in read_df_dictionary(spark, str(tmp_path / "df")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert found == {f"t{i}": 4995 + i for i in range(5)}


def parts(folder):
    return ["".join(open(p, encoding="utf8").read()) for p in sorted(glob.glob(f"{folder}/part-*"))]


def test_parts_in_name_order_are_sorted_by_key_bytes(spark, tmp_path):
    rows = [(w, i) for i, w in enumerate(["b", "a", "zz", "é", "z", "Z", "aa"] + [f"w{n}" for n in range(200)])]
    counts = spark.createDataFrame(rows, "word string, n long").repartition(5)
    write_lines(render_tsv(counts, "word", "n"), str(tmp_path / "out"))
    lines = "".join(parts(tmp_path / "out")).splitlines()
    assert lines == sorted((f"{w}\t{i}" for w, i in rows), key=lambda line: line.split("\t")[0].encode())


def test_one_file_and_no_overwriting(spark, lines_from, tmp_path):
    lines, top = lines_from({"a": ["war world war"]}), word_list(spark, ["war", "world"])
    out = str(tmp_path / "pairs")
    write_lines(render_pairs(pair_counts(lines, top, 1)), out, single_file=True)
    assert parts(out) == ["war,world\t1\nworld,war\t1\n"]
    with pytest.raises(AnalysisException):
        write_lines(render_pairs(pair_counts(lines, top, 1)), out)
    write_lines(render_stripes(stripes(lines, top, 2)), str(tmp_path / "stripes"), single_file=True)
    assert parts(tmp_path / "stripes") == ["war\t{war=1, world=1}\nworld\t{war=1}\n"]


def test_scores_have_six_decimals(spark):
    scores = spark.createDataFrame([(7, "run", 25.5521799)], "doc_id long, term string, score double")
    assert render_scores(scores).first().line == "7\trun\t25.552180"


def test_stripe_text_is_sorted(spark):
    row = spark.createDataFrame([({"b": 1, "a": 2},), ({},)], "m map<string,long>")
    assert [r[0] for r in row.select(stripe_text(F.col("m"))).collect()] == ["{a=2, b=1}", "{}"]


def test_tables_are_dealt_out_only_on_request(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    assert "RoundRobinPartitioning" not in read_table(spark, path, "text")._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning" in read_table(spark, path, "text", partitions=3)._jdf.queryExecution().toString()
