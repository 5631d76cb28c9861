"""The jobs run from the command line one after the other, list files between them."""

import glob

import pytest

from lexigrid.__main__ import run


def lines_in(folder):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{folder}/part-*"))).splitlines()


@pytest.fixture()
def texts(tmp_path):
    folder = tmp_path / "texts"
    folder.mkdir()
    (folder / "a.txt").write_text("The running war, the world\nwar world xii\n")
    (folder / "b.txt").write_text("War runs. world\n")
    (tmp_path / "stop").write_text("the\n")
    return folder, tmp_path


def test_words_then_matrix(spark, texts):
    folder, tmp = texts
    run(spark, ["wordcount", str(folder), f"{tmp}/top", "--stopwords", f"{tmp}/stop", "--top", "2"])
    assert lines_in(tmp / "top") == ["war\t3", "world\t3"]
    run(spark, ["wordcount", str(folder), f"{tmp}/all", "--stopwords", f"{tmp}/stop"])
    assert lines_in(tmp / "all") == ["running\t1", "runs\t1", "war\t3", "world\t3"]
    run(spark, ["wordcount", str(folder), f"{tmp}/ranked", "--top", "9"])
    assert [line.split("\t")[0] for line in lines_in(tmp / "ranked")] == ["war", "world", "the", "running", "runs"]
    for extra in ([], ["--by-line"]):
        out = f"{tmp}/pairs{len(extra)}"
        run(spark, ["pairs", str(folder), out, "--top-words", f"{tmp}/top", "-d", "2", *extra])
        assert lines_in(out) == ["war,world\t3"]
        out = f"{tmp}/stripes{len(extra)}"
        run(spark, ["stripes", str(folder), out, "--top-words", f"{tmp}/top", "-d", "2", *extra])
        assert lines_in(out) == ["war\t{world=3}", "world\t{}"]


def test_loose_neighbours(spark, texts):
    folder, tmp = texts
    (tmp / "list").write_text("world\nxii\n")
    for extra in ([], ["--by-line"]):
        out = f"{tmp}/loose{len(extra)}"
        run(spark, ["stripes", str(folder), out, "--top-words", f"{tmp}/list", "--loose", *extra])
        assert lines_in(out) == ["world\t{xii=1}"]


def test_case_mode(spark, texts):
    folder, tmp = texts
    run(spark, ["wordcount", str(folder), f"{tmp}/strict", "--case-mode", "capitals_separate"])
    assert lines_in(tmp / "strict") == ["running\t1", "runs\t1", "the\t1", "war\t2", "world\t3"]


def test_documents_then_scores(spark, texts):
    folder, tmp = texts
    run(spark, ["df", str(folder), f"{tmp}/df", "--stopwords", f"{tmp}/stop", "--top", "100"])
    assert lines_in(tmp / "df") == ["run\t2", "war\t2", "world\t2"]
    run(spark, ["tfidf", str(folder), f"{tmp}/scores", "--dictionary", f"{tmp}/df"])
    assert lines_in(tmp / "scores") == [
        "a\trun\t8.517393", "a\twar\t17.034786", "a\tworld\t17.034786",
        "b\trun\t8.517393", "b\twar\t8.517393", "b\tworld\t8.517393",
    ]
